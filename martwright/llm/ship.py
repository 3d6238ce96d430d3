"""Functions of this package in Python workers: makes them importable there and keeps the workers small."""

from __future__ import annotations

import ctypes
import functools
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Texts travel to the workers in batches of at most so many bytes, or one row.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

_done: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Adds the package to the session's files once, as ``spark-submit --py-files`` would, and bounds Arrow batches.

    Batches that the session has set to something smaller stay as they are.
    """
    context = spark.sparkContext
    in_bytes = context._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if in_bytes(str(spark.conf.get(_BATCH))) > BATCH_BYTES:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    if context.applicationId in _done:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="martwright-"), "martwright_package.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(target)
    _done.add(context.applicationId)


def shipped(rows: DataFrame) -> DataFrame:
    """``rows``, ready for functions of this package."""
    ship(rows.sparkSession)
    return rows


def give_back() -> None:
    """Returns freed memory to the system: a worker lives on after its task, beside those of other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Callable) -> Callable:
    """``run``, over batches or over a group, that gives back memory when it is done."""

    @functools.wraps(run)
    def batches(items: Iterator) -> Iterator:
        yield from run(items)
        give_back()

    return batches


def lean_group(run: Callable) -> Callable:
    """The same for a function of one or two tables."""

    def group(*tables: pa.Table) -> pa.Table:
        try:
            return run(*tables)
        finally:
            give_back()

    def one(table: pa.Table) -> pa.Table:
        return group(table)

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        return group(left, right)

    return two if run.__code__.co_argcount == 2 else one
