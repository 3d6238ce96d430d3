"""A folder for intermediate tables that every executor can reach."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import SparkSession

_local: list[tempfile.TemporaryDirectory] = []


def scratch_path(spark: SparkSession) -> str:
    """A new path under ``spark.checkpoint.dir``; a temporary folder only in local mode without it."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/martwright-{uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    _local.append(tempfile.TemporaryDirectory(prefix="martwright-"))
    return _local[-1].name


def scratch_dir(spark: SparkSession) -> str:
    """A path to write to that goes with the driver: a folder of its own is made now and removed at exit."""
    folder, files = _folder(spark, scratch_path(spark))
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{folder.toString()}/data"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A scratch folder that is removed afterwards; for results that no longer read from it."""
    folder, files = _folder(spark, scratch_path(spark))
    try:
        yield folder.toString()
    finally:
        files.delete(folder, True)


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
