"""Where tables live: ``{root}/{layer}/{name}``, raw files under ``{root}/raw/{dataset}/{file}``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from martwright.plans.datasets import DATASETS
from martwright.sources import versions


@dataclass(frozen=True)
class Layout:
    root: str

    def raw(self, dataset: str) -> str:
        return f"{self.root}/raw/{dataset}/{DATASETS[dataset].raw_file}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}/"

    def report(self, run_id: str) -> str:
        return f"{self.root}/quality-reports/{run_id}/"

    def run_metrics(self, run_id: str, stage: str) -> str:
        return f"{self.root}/run-metrics/run_id={run_id}/stage={stage}/"

    def quality_metrics(self, run_id: str) -> str:
        return f"{self.root}/quality-metrics/run_id={run_id}/"


def new_run_id() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the table's current version; what is committed later does not change them."""
    return versions.frame(spark, path)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    buckets: int = 0,
    made_from: Mapping[str, str] | None = None,
) -> int:
    """Replace the table at ``path`` as a whole and return its rows; if the write fails, it stays as it was."""
    return versions.replace(df, path, partition_by, bucket_by, buckets, made_from).rows


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files of a table's current version, or of all files of a folder, from the file system's listing."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(versions.folder_of(spark, path))
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(files.getContentSummary(target).getLength())


def write_report(report: DataFrame, path: str) -> None:
    """A report of a few dozen rows as one CSV file with a header."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def publish(spark: SparkSession, layout: Layout, layer: str, names: Sequence[str], database: str | None = None) -> None:
    """Register written tables in the session catalog as external tables, ready for ``spark.sql``.

    A table is registered at the folder of its current version and stays there until it is published again; that folder
    is kept for some time after it was replaced (``versions.GRACE``). A table that is already registered for a version of
    the same table with the same columns is moved to the current one; no data is touched. Any other table or view of
    that name raises before anything is registered, and so does one whose columns have changed since.
    """
    if database:
        spark.sql(f"create database if not exists `{database}`")
    wanted = {f"`{database}`.`{name}`" if database else f"`{name}`": layout.table(layer, name) for name in names}
    known = {table for table in wanted if spark.catalog.tableExists(table)}
    for table in sorted(known):
        _check_registered(spark, table, wanted[table])
    for table, path in wanted.items():
        version = versions.current(spark, path)
        folder = _qualified(spark, version.folder if version else path)
        if table in known and not _has_partitions(spark, table):
            spark.sql(f"alter table {table} set location '{folder}'")
            spark.catalog.refreshTable(table)
            continue
        if table in known:  # its partitions lie in the folder it was at; the table is external, so only the entry goes
            spark.sql(f"drop table {table}")
        if version and version.partitioned_by:
            columns = ", ".join(f"`{name}`" for name in version.partitioned_by)
            spark.sql(f"create table {table} ({version.ddl}) using parquet partitioned by ({columns}) location '{folder}'")
        else:
            spark.catalog.createTable(table, path=folder, source="parquet")
        if _has_partitions(spark, table):
            spark.catalog.recoverPartitions(table)


def _has_partitions(spark: SparkSession, table: str) -> bool:
    return any(column.isPartition for column in spark.catalog.listColumns(table))


def _check_registered(spark: SparkSession, table: str, path: str) -> None:
    described = {row["col_name"]: row["data_type"] for row in spark.sql(f"describe table extended {table}").collect()}
    root = _qualified(spark, path).rstrip("/")
    if described.get("Type") != "EXTERNAL" or not (_qualified(spark, described["Location"]) + "/").startswith(f"{root}/"):
        raise ValueError(f"{table} exists and is not the external table at {path}; rename or drop it to publish there")
    stored = {(field.name, field.dataType) for field in read_table(spark, path).schema.fields}
    if {(field.name, field.dataType) for field in spark.table(table).schema.fields} != stored:
        raise ValueError(f"{table} is registered with other columns than those at {path}; drop it to publish them")


def _qualified(spark: SparkSession, path: str) -> str:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.makeQualified(target).toString()
