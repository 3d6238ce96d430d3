"""Runs compared with the runs before them, over the stored run metrics and quality reports.

A run is known by its id, and ids sort by time. Rows of different datasets, stages or rules are never compared, so the
windows are partitioned by them; each holds a row per run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec, functions as F

from martwright.plans.jobs import SUCCESS, UNCHANGED
from martwright.plans.quality import FAIL, PASS
from martwright.sources.layout import Layout

# How a rule stands against the run before.
NEW, STILL, MENDED, FIRST = "NEWLY FAILING", "STILL FAILING", "MENDED", "FIRST CHECK"


def _runs(*keys: str) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy("run_id")


def run_changes(metrics: DataFrame) -> DataFrame:
    """Each run of a stage and dataset beside the run before it: what it wrote, what changed, and since when.

    ``metrics`` has the columns of the run metrics with run_id and stage. ``rows_change`` is the difference to the last
    run that wrote the table (runs that failed or were skipped wrote nothing and are passed over), ``percent_change`` the same in
    percent, NULL without such a run or where it left no rows. ``status_change`` says whether the status differs from
    the run before; the first run has none to differ from. ``runs_in_status`` counts the runs in a row with this status.
    """
    order = _runs("stage", "dataset")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    wrote = F.when(F.col("status").isin(SUCCESS, UNCHANGED), F.col("rows_after"))
    written = F.last(wrote, ignorenulls=True).over(earlier)
    before = F.lag("status").over(order)
    marked = metrics.select(
        "run_id",
        "stage",
        "dataset",
        "status",
        "rows_after",
        wrote.alias("wrote"),
        written.alias("wrote_before"),
        before.alias("status_before"),
    ).withColumn("turn", F.sum(F.when(F.col("status").eqNullSafe(F.col("status_before")), 0).otherwise(1)).over(order))
    change = F.col("wrote") - F.col("wrote_before")
    percent = F.try_divide(change * 100, F.col("wrote_before").cast("decimal(20,0)"))
    return marked.select(
        "run_id",
        "stage",
        "dataset",
        "status",
        "rows_after",
        change.alias("rows_change"),
        F.round(percent, 2).cast("decimal(20,2)").alias("percent_change"),
        (F.col("status") != F.col("status_before")).alias("status_change"),
        F.count(F.lit(1)).over(_runs("stage", "dataset", "turn").rowsBetween(Window.unboundedPreceding, 0)).alias("runs_in_status"),
    )


def rule_changes(reports: DataFrame) -> DataFrame:
    """Each rule of each run beside the run before that checked it.

    ``reports`` has the columns of the quality report with run_id. ``trend`` is one of the names above, or PASS for a rule
    that passes again; a rule that is not checked has none and is passed over by later runs. ``rows_change`` is the
    difference in failing rows, ``failing_since`` the first of the runs in a row in which the rule fails.
    """
    order = _runs("dataset", "rule")
    checked = reports.where(F.col("status").isin(PASS, FAIL))
    failing = F.col("status") == FAIL
    before = F.lag("status").over(order)
    turn = F.sum(F.when(failing, 0).otherwise(1)).over(order)
    compared = checked.select(
        "run_id",
        "dataset",
        "rule",
        "status",
        "failed_rows",
        (F.col("failed_rows") - F.lag("failed_rows").over(order)).alias("rows_change"),
        _trend(before).alias("trend"),
        turn.alias("turn"),
    )
    # a turn begins with a passing run, or with the first one
    since = F.min(F.when(failing, F.col("run_id"))).over(Window.partitionBy("dataset", "rule", "turn"))
    with_since = compared.withColumn("failing_since", F.when(failing, since)).drop("turn")
    unchecked = reports.where(~F.col("status").isin(PASS, FAIL)).select("run_id", "dataset", "rule", "status", "failed_rows")
    return with_since.unionByName(unchecked, allowMissingColumns=True)


def _trend(before: Column) -> Column:
    failing, failed = F.col("status") == FAIL, before == FAIL
    return (
        F.when(before.isNull(), FIRST)
        .when(failing & failed, STILL)
        .when(failing, NEW)
        .when(failed, MENDED)
        .otherwise(PASS)
    )


def stored_metrics(spark: SparkSession, layout: Layout) -> DataFrame:
    """The run metrics of all runs; run ids stay text."""
    kind = "dataset string, rows_before bigint, rows_after bigint, rows_removed bigint, status string, duration double"
    return spark.read.schema(f"{kind}, run_id string, stage string").parquet(f"{layout.root}/run-metrics")


def stored_reports(spark: SparkSession, layout: Layout) -> DataFrame:
    """The quality reports of all runs; the run id is the name of a report's folder."""
    kind = "dataset string, failed_rows bigint, rule string, status string, validation_time string"
    rows = spark.read.schema(kind).option("header", True).csv(f"{layout.root}/quality-reports/*/")
    return rows.withColumn("run_id", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)).drop("validation_time")
