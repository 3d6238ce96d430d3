"""The batch jobs: raw to bronze, bronze to silver, silver to gold, and the quality report."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from martwright.functions.calendar import purchase_month
from martwright.operators.hitters import heavy_hitters
from martwright.plans import gold, quality
from martwright.plans.datasets import DATASETS
from martwright.plans.silver import missing_columns, silver
from martwright.session import shuffle_partitions_for, sized_session
from martwright.sources.layout import (
    Layout,
    new_run_id,
    publish,
    read_table,
    stored_bytes,
    write_report,
    write_table,
)
from martwright.sources.raw_csv import RECORD, REJECTED, read_checked, read_raw, rejected_records
from martwright.sources.versions import Version, current, fingerprint

log = logging.getLogger("martwright")

SUCCESS, SCHEMA_FAILED, FAILED = "SUCCESS", "SCHEMA FAILED", "FAILED"

# A resumed job found the table made from the same inputs, and left it.
UNCHANGED = "UNCHANGED"

# To be raised when the plans change what they write: tables of another number are made again by a resumed job.
PLANS = 1

METRICS = "dataset string, rows_before bigint, rows_after bigint, rows_removed bigint, status string, duration double"

REPORT = "dataset string, failed_rows bigint, rule string, status string, validation_time string"

GOLD_TABLES = (
    "dim_customers",
    "dim_products",
    "dim_sellers",
    "dim_date",
    "fact_orders",
    "fact_order_items",
    "fact_order_payments",
)


def run_bronze(
    spark: SparkSession,
    layout: Layout,
    datasets: Iterable[str] = DATASETS,
    infer: bool = False,
    workers: int = 4,
    strict: bool = False,
    resume: bool = False,
) -> DataFrame:
    """Raw CSV to Parquet; returns the run metrics.

    Records that do not fit the contract are written to the dataset's table in the ``rejected`` layer, as text and with
    the reasons. In bronze their bad fields are NULL; with ``strict`` they are left out of it, so bronze and rejected
    rows together are the raw records. The data is parsed once, and again only if there are such records.
    """

    def ingest(name: str) -> tuple[int, int, str]:
        target, source = layout.table("bronze", name), layout.raw(name)
        made_from = _made_from(spark, [source], infer=infer, strict=strict)
        quarantine = layout.table("rejected", name)
        done = _unchanged(spark, target, made_from) if resume else None
        held = _unchanged(spark, quarantine, made_from) if done and not infer else None
        if done and (held or infer):
            return done.rows + (held.rows if held and strict else 0), done.rows, UNCHANGED
        own = sized_session(spark, stored_bytes(spark, source))
        if infer:
            rows = write_table(read_raw(own, source, DATASETS[name], infer=True), target, made_from=made_from)
            return rows, rows, SUCCESS
        seen = Observation()
        checked = read_checked(own, source, DATASETS[name])
        counted = checked.observe(seen, F.count_if(F.col(RECORD).isNotNull()).alias("rejected"))
        kept = counted.where(F.col(RECORD).isNull()) if strict else counted
        rows = write_table(kept.drop(RECORD), target, made_from=made_from)
        found = rejected_records(checked, DATASETS[name]) if seen.get["rejected"] else own.createDataFrame([], REJECTED)
        bad = write_table(found, quarantine, made_from=made_from)
        return (rows + bad if strict else rows), rows, SUCCESS

    return _run(spark, datasets, ingest, workers)


def stored_tables(spark: SparkSession, layout: Layout, layer: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Written tables of one layer, in a session sized for all of them together: what is planned on them keeps it.

    The figures take their tables from here; each job below takes those of the table it builds.
    """
    paths = {name: layout.table(layer, name) for name in names}
    own = sized_session(spark, sum(stored_bytes(spark, path) for path in paths.values()))
    return {name: read_table(own, path) for name, path in paths.items()}


def run_silver(
    spark: SparkSession,
    layout: Layout,
    datasets: Iterable[str] = DATASETS,
    workers: int = 4,
    colocate: bool = True,
    resume: bool = False,
) -> DataFrame:
    """Bronze to silver; returns the run metrics.

    Each dataset is cleaned and written in one action; both row counts come from Parquet footers. With ``colocate``
    orders, items and payments are dealt by order into the same number of sorted buckets, so that the facts and figures
    made from them are joined without a shuffle; a table with an order that would overfill its bucket is not dealt.

    A dataset that lacks contract columns is skipped with zero counts, and its earlier silver table
    stays. So does that of one that fails, which has no counts. Neither stops the others.
    """
    names = list(datasets)
    buckets = _buckets(spark, layout) if colocate and CO_LOCATED.keys() & set(names) else 0

    def clean(name: str) -> tuple[int, int, str]:
        target, source = layout.table("silver", name), layout.table("bronze", name)
        dealt = buckets if name in CO_LOCATED else 0
        made_from = _made_from(spark, [source], buckets=dealt)
        done = _unchanged(spark, target, made_from) if resume else None
        rows = stored_tables(spark, layout, "bronze", [name])[name]
        if done:
            return rows.count(), done.rows, UNCHANGED
        missing = missing_columns(name, rows)
        if missing:
            log.warning("%s lacks %s", name, ", ".join(missing))
            return 0, 0, SCHEMA_FAILED
        key = CO_LOCATED.get(name)
        if dealt and DATASETS[name].key != (key,) and heavy_hitters(rows, key, dealt).counts:
            log.info("%s is not dealt by %s, which has heavy hitters", name, key)
            dealt = 0
        written = write_table(
            silver(name, rows), target, bucket_by=(key,) if dealt else (), buckets=dealt, made_from=made_from
        )
        return rows.count(), written, SUCCESS

    return _run(spark, names, clean, workers)


# Tables that are joined on one key and stored in equal buckets of it.
CO_LOCATED = {"orders": "order_id", "order_items": "order_id", "payments": "order_id"}


def _buckets(spark: SparkSession, layout: Layout) -> int:
    """Buckets that suit the co-located tables together: a power of two, so that later numbers divide one another."""
    found = [layout.table("bronze", name) for name in CO_LOCATED]
    size = sum(stored_bytes(spark, path) for path in found if fingerprint(spark, path))
    return 1 << (shuffle_partitions_for(size, spark.sparkContext.defaultParallelism) - 1).bit_length()


def run_gold(
    spark: SparkSession,
    layout: Layout,
    tables: Iterable[str] = GOLD_TABLES,
    partition_facts: bool = False,
    workers: int = 4,
    resume: bool = False,
) -> DataFrame:
    """Silver to gold; returns the run metrics, with the rows written as both counts.

    Orders too large for one task, and categories with very many products, are looked for in the written silver tables
    first. ``partition_facts`` stores the facts by year and month of purchase, in two further columns.
    """

    def build(name: str) -> tuple[int, int, str]:
        target = layout.table("gold", name)
        sources_at = [layout.table("silver", source) for source in GOLD_SOURCES[name]]
        made_from = _made_from(spark, sources_at, by_month=partition_facts)
        done = _unchanged(spark, target, made_from) if resume else None
        if done:
            return done.rows, done.rows, UNCHANGED
        sources = stored_tables(spark, layout, "silver", GOLD_SOURCES[name])
        details = {source: sources[source] for source in ("order_items", "payments") if source in sources}
        measured = {}
        if name in CHUNKED:
            measured["oversized"] = gold.oversized_details(**details)
        if name == "dim_products":
            tasks = int(sources["products"].sparkSession.conf.get("spark.sql.shuffle.partitions"))
            measured["hitters"] = gold.category_hitters(sources["products"], tasks)
        table = gold_table(name, sources.__getitem__, **measured)
        months: tuple[str, ...] = ()
        if partition_facts and name.startswith("fact_"):
            months = ("order_year", "order_month")
            table = table.select("*", *purchase_month(*months))
        rows = write_table(table, target, partition_by=months, made_from=made_from)
        return rows, rows, SUCCESS

    return _run(spark, tables, build, workers)


GOLD_SOURCES = {
    "dim_customers": ("customers",),
    "dim_products": ("products", "categories"),
    "dim_sellers": ("sellers",),
    "dim_date": ("orders",),
    "fact_orders": ("orders", "order_items", "payments"),
    "fact_order_items": ("orders", "order_items"),
    "fact_order_payments": ("orders", "payments"),
}

# The facts that have a row for every detail row of an order.
CHUNKED = ("fact_orders", "fact_order_items")


def gold_table(name: str, silver_table: Callable[[str], DataFrame], **measured) -> DataFrame:
    """One gold table from whatever ``silver_table`` supplies; planned without running a job.

    ``measured`` is passed to the plan: ``oversized`` and ``chunk_rows`` for the facts in ``CHUNKED``, ``hitters`` for
    ``dim_products``.
    """
    return getattr(gold, name)(*[silver_table(source) for source in GOLD_SOURCES[name]], **measured)


def publish_gold(spark: SparkSession, layout: Layout, database: str | None = None) -> None:
    publish(spark, layout, "gold", GOLD_TABLES, database)


def run_quality(spark: SparkSession, layout: Layout, run_id: str | None = None) -> DataFrame:
    """Check the bronze tables, write the report under a run-stamped path and return it as written.

    Rules over a table or column that is not there are reported as not checked.
    """
    tables = _found(spark, layout, "bronze", quality.SUITE)
    target = layout.report(run_id or new_run_id())
    stamped = quality.report(tables).withColumn("validation_time", F.current_timestamp().cast("string"))
    write_report(stamped, target)
    return spark.read.schema(REPORT).option("header", True).csv(target)


def check_references(spark: SparkSession, layout: Layout, layer: str = "bronze") -> DataFrame:
    """Orphans of each relation between the tables of a layer; one over a table that is not there is not checked."""
    return quality.reference_report(_found(spark, layout, layer, DATASETS))


def check_record_counts(spark: SparkSession, layout: Layout, datasets: Iterable[str] = DATASETS) -> DataFrame:
    """Rows of each bronze table against those of its silver table; one that is not there is not checked."""
    names = list(datasets)
    return quality.record_counts(*[_found(spark, layout, layer, names) for layer in ("bronze", "silver")])


def _found(spark: SparkSession, layout: Layout, layer: str, names: Iterable[str]) -> dict[str, DataFrame | None]:
    """The written tables, None for one that cannot be read."""
    tables: dict[str, DataFrame | None] = {}
    for name in names:
        try:
            tables[name] = read_table(spark, layout.table(layer, name))
        except AnalysisException as error:
            log.warning("%s %s cannot be read: %s", layer, name, error.getCondition())
            tables[name] = None
    return tables


def run_summary(metrics: DataFrame) -> DataFrame:
    """Datasets processed, successes, failures and row totals of one run, in one row."""
    return metrics.agg(
        F.count(F.lit(1)).alias("datasets_processed"),
        F.count_if(F.col("status").isin(SUCCESS, UNCHANGED)).alias("successful_jobs"),
        F.count_if(~F.col("status").isin(SUCCESS, UNCHANGED)).alias("failed_jobs"),
        F.coalesce(F.sum("rows_before"), F.lit(0)).alias("rows_read"),
        F.coalesce(F.sum("rows_after"), F.lit(0)).alias("rows_written"),
        F.coalesce(F.sum("rows_removed"), F.lit(0)).alias("rows_removed"),
    )


def _made_from(spark: SparkSession, paths: Iterable[str], **settings: object) -> dict[str, str]:
    """Fingerprints of a table's inputs, and what else its rows depend on; kept in the table's commit record."""
    return {path: fingerprint(spark, path) for path in paths} | {k: str(v) for k, v in settings.items()} | {"plans": str(PLANS)}


def _unchanged(spark: SparkSession, target: str, made_from: dict[str, str]) -> Version | None:
    """The current version of a table, if it was made from these very inputs."""
    found = current(spark, target)
    return found if found and found.made_from == made_from else None


def _run(
    spark: SparkSession, names: Iterable[str], work: Callable[[str], tuple[int, int, str]], workers: int
) -> DataFrame:
    """Do ``work`` per name, several at a time so that small tables fill the gaps of large ones."""

    def one(name: str) -> tuple:
        started = time.monotonic()
        try:
            before, after, status = work(name)
            removed = before - after
        except Exception:
            log.exception("%s failed", name)
            before, after, removed, status = None, None, None, FAILED
        return name, before, after, removed, status, round(time.monotonic() - started, 2)

    with ThreadPoolExecutor(max_workers=workers) as pool:
        return spark.createDataFrame(list(pool.map(one, names)), METRICS)
