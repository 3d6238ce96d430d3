"""Every operator as a query over the driver's test tables.

Each takes the session and the folder of the Parquet tables, shapes them into bronze datasets and
runs the plan on the whole of them.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from martwright.operators.clean import generic_clean, trim_strings
from martwright.plans import gold, history, jobs, kpi, quality
from martwright.plans.changes import apply_batch, current_silver
from martwright.plans.datasets import DATASETS, Dataset
from martwright.plans.silver import missing_columns, silver
from martwright.sources.layout import Layout, publish, read_table, write_table
from martwright.sources.raw_csv import CSV, read_raw
from martwright.sources.scratch import scratch, scratch_dir
from martwright.streaming import silver as stream
from martwright.testing import shapes

Query = Callable[[SparkSession, str], DataFrame]

# Contract columns taken away to make the schema check report something.
DROPPED = {"order_items": "price", "sellers": "seller_city"}


class Tables(shapes.Shapes):
    """The shaped datasets of one folder, through all layers."""

    def silver(self, name: str) -> DataFrame:
        return silver(name, self.bronze(name))

    def gold(self, name: str) -> DataFrame:
        return jobs.gold_table(name, self.silver)

    def write_bronze(self, layout: Layout) -> None:
        """The bronze layer as Parquet tables."""
        with ThreadPoolExecutor(max_workers=4) as pool:
            list(pool.map(lambda name: write_table(self.bronze(name), layout.table("bronze", name)), DATASETS))


def bronze_csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as a raw CSV, ingested, and read back from the bronze table."""
    layout = Layout(scratch_dir(spark))
    shaped = Tables(spark, sf_dir).bronze("orders")
    shaped.write.options(**CSV).csv(layout.raw("orders"))
    spec = Dataset(
        name="orders",
        raw_file=DATASETS["orders"].raw_file,
        required={name: kind.simpleString() for name, kind in ((f.name, f.dataType) for f in shaped.schema.fields)},
    )
    write_table(read_raw(spark, layout.raw("orders"), spec), layout.table("bronze", "orders"))
    return read_table(spark, layout.table("bronze", "orders"))


def bronze_contract_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine datasets written as raw CSV, ingested by the job with their contract, each row as one text."""
    layout = Layout(scratch_dir(spark))
    _raw_files(layout, Tables(spark, sf_dir), *DATASETS)
    jobs.run_bronze(spark, layout)
    return quality.stack(_as_text(name, read_table(spark, layout.table("bronze", name))) for name in DATASETS)


def schema_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns missing from two doctored tables, with the rows they keep out of silver."""
    tables = Tables(spark, sf_dir)
    found = []
    for name in DATASETS:
        rows = tables.bronze(name)
        if name in DROPPED:
            rows = rows.drop(DROPPED[name])
        for column in missing_columns(name, rows):
            found.append(
                rows.agg(F.count(F.lit(1)).alias("blocked_rows")).select(
                    F.lit(name).alias("dataset"), F.lit(column).alias("missing_column"), "blocked_rows"
                )
            )
    return quality.stack(found)


def silver_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver job over written bronze tables; wall-clock column left out."""
    with scratch(spark) as folder:
        layout = Layout(folder)
        Tables(spark, sf_dir).write_bronze(layout)
        return jobs.run_silver(spark, layout).drop("duration")


def silver_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.run_summary(silver_run_metrics(spark, sf_dir))


def silver_run_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver job over a good table, one without a contract column and one that is not there."""
    with scratch(spark) as folder:
        layout, tables = Layout(folder), Tables(spark, sf_dir)
        write_table(tables.bronze("customers"), layout.table("bronze", "customers"))
        write_table(tables.bronze("order_items").drop("price"), layout.table("bronze", "order_items"))
        return jobs.run_silver(spark, layout, ["customers", "order_items", "geolocation"]).drop("duration")


def record_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the written tables, after the silver job; one row per dataset."""
    with scratch(spark) as folder:
        layout = Layout(folder)
        Tables(spark, sf_dir).write_bronze(layout)
        jobs.run_silver(spark, layout)
        counted = jobs.check_record_counts(spark, layout)
        return spark.createDataFrame(counted.collect(), counted.schema)


def _written_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality report as the job leaves it, read from its CSV file."""
    layout = Layout(scratch_dir(spark))
    Tables(spark, sf_dir).write_bronze(layout)
    return jobs.run_quality(spark, layout)


AS_THEY_ARE = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _raw_files(layout: Layout, tables: Tables, *names: str) -> None:
    """Raw files of some datasets, several at a time so that small ones fill the gaps of large ones."""
    frames = {name: tables.raw(name) for name in names}
    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(lambda name: frames[name].write.options(**CSV, **AS_THEY_ARE).csv(layout.raw(name)), names))


def _as_text(name: str, rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Each row as one text beside the name of its dataset."""
    values = [F.coalesce(F.col(column).cast("string"), F.lit("NULL")) for column in columns or rows.columns]
    return rows.select(F.lit(name).alias("dataset"), F.concat_ws("|", *values).alias("record"))


def bronze_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files with bad fields, ingested strictly: the rows that fit, and the reasons of those that do not."""
    layout, tables = Layout(scratch_dir(spark)), Tables(spark, sf_dir)
    for name in shapes.DIRTY:
        tables.dirty(name).write.options(**CSV, **AS_THEY_ARE).csv(layout.raw(name))
    jobs.run_bronze(spark, layout, list(shapes.DIRTY), strict=True)
    found = []
    for name in shapes.DIRTY:
        parsed = _as_text(name, read_table(spark, layout.table("bronze", name)))
        rejected = read_table(spark, layout.table("rejected", name))
        reasons = rejected.select(F.lit(name).alias("dataset"), F.concat_ws("; ", "reasons").alias("record"))
        found += [parsed.withColumn("fate", F.lit("parsed")), reasons.withColumn("fate", F.lit("rejected"))]
    return quality.stack(found)


def silver_failed_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A silver table whose second write fails in its tasks, as it is read afterwards."""
    path, customers = Layout(scratch_dir(spark)).table("silver", "customers"), Tables(spark, sf_dir).silver("customers")
    write_table(customers, path)
    city = F.col("customer_city")
    doomed = customers.withColumn("customer_city", F.when(city.isNotNull(), F.raise_error(F.lit("made to fail"))).otherwise(city))
    try:
        write_table(doomed, path)
    except PySparkException:
        return read_table(spark, path)
    raise AssertionError("the second write should have failed")


#: Batches that a dataset is split into, and the datasets that are merged from them.
BATCHES = 3
MERGED = ("customers", "orders", "order_items", "categories")


def silver_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of some datasets whose bronze rows arrive in batches and are merged by key, each row as one text."""
    layout, tables = Layout(scratch_dir(spark)), Tables(spark, sf_dir)

    def merge(name: str) -> DataFrame:
        rows, landed = tables.bronze(name), layout.table("landed", name)
        batch = F.pmod(F.xxhash64(*rows.columns), F.lit(BATCHES)).cast("int")
        rows.withColumn("__batch", batch).write.partitionBy("__batch").parquet(landed)
        arrived = spark.read.schema(rows.withColumn("__batch", batch).schema).parquet(landed)
        for number in range(BATCHES):
            apply_batch(spark, layout, name, arrived.where(F.col("__batch") == number).drop("__batch"), parts=16)
        return _as_text(name, current_silver(spark, layout, name))

    with ThreadPoolExecutor(max_workers=len(MERGED)) as pool:
        return quality.stack(pool.map(merge, MERGED))


def silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver orders from raw files that are streamed, stopped after a part of them, and streamed on."""
    layout, tables = Layout(scratch_dir(spark)), Tables(spark, sf_dir)
    rows, checkpoint = tables.raw("orders"), scratch_dir(spark)
    first = F.pmod(F.xxhash64(*rows.columns), F.lit(2)) == 0
    for part in (rows.where(first), rows.where(~first)):
        part.write.mode("append").options(**CSV).csv(layout.raw("orders"))
        query = stream.start(spark, layout, "orders", checkpoint, files_per_batch=2, parts=16, columns=rows.columns)
        query.awaitTermination()
    return current_silver(spark, layout, "orders")


def _colocated(plan: Callable[..., DataFrame], *names: str) -> Query:
    """A plan over silver tables that the job has stored in buckets."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        layout, tables = Layout(scratch_dir(spark)), Tables(spark, sf_dir)
        for name in names:
            write_table(tables.bronze(name), layout.table("bronze", name))
        jobs.run_silver(spark, layout, names)
        return plan(**jobs.stored_tables(spark, layout, "silver", names))

    return query


#: Rows of an order that a task joins at a time in the chunked facts, and tasks for which a category counts as hot.
FEW_ROWS, MANY_TASKS = 2, 200


def _chunked(name: str) -> Query:
    """A fact whose larger orders are found in the written silver tables and cut into chunks."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        layout, tables = Layout(scratch_dir(spark)), Tables(spark, sf_dir)

        def stored(part: str) -> DataFrame:
            write_table(tables.silver(part), layout.table("silver", part))
            return read_table(spark, layout.table("silver", part))

        with ThreadPoolExecutor(max_workers=4) as pool:
            silver_tables = dict(zip(jobs.GOLD_SOURCES[name], pool.map(stored, jobs.GOLD_SOURCES[name]), strict=True))
        details = {part: rows for part, rows in silver_tables.items() if part in ("order_items", "payments")}
        oversized = gold.oversized_details(**details, chunk_rows=FEW_ROWS)
        return jobs.gold_table(name, silver_tables.__getitem__, oversized=oversized, chunk_rows=FEW_ROWS)

    return query


def dim_products_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product dimension with the categories that hold many products dealt over tasks."""
    tables = Tables(spark, sf_dir)
    hitters = gold.category_hitters(tables.silver("products"), MANY_TASKS)
    return jobs.gold_table("dim_products", tables.silver, hitters=hitters)


RUN_IDS = ("20240101_000000", "20240102_000000", "20240103_000000")


def rule_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs of the quality job: over bronze, over the cleaned rows instead, and over bronze twice."""
    layout, tables = Layout(scratch_dir(spark)), Tables(spark, sf_dir)
    first: dict[str, DataFrame] = {}  # the rows as the first run leaves them, on their version
    states = (tables.bronze, lambda name: silver(name, first[name]), lambda name: first[name].union(first[name]))
    for run_id, state in zip(RUN_IDS, states, strict=True):
        with ThreadPoolExecutor(max_workers=4) as pool:
            list(pool.map(lambda name, state=state: write_table(state(name), layout.table("bronze", name)), quality.SUITE))
        first = first or {name: read_table(spark, layout.table("bronze", name)) for name in quality.SUITE}
        jobs.run_quality(spark, layout, run_id)
    return history.rule_changes(history.stored_reports(spark, layout))


def run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four runs of the silver job: as it is, with a column missing, as it is again, and with the cleaned rows as input."""
    layout, tables = Layout(scratch_dir(spark)), Tables(spark, sf_dir)
    names = ("customers", "sellers")
    broken = {"sellers": lambda: tables.bronze("sellers").drop("seller_city")}
    for number, state in enumerate(("bronze", "broken", "bronze", "silver"), 1):
        for name in names:
            source = tables.silver(name) if state == "silver" else tables.bronze(name)
            write_table(broken[name]() if state == "broken" and name in broken else source, layout.table("bronze", name))
        metrics = jobs.run_silver(spark, layout, names)
        metrics.write.parquet(layout.run_metrics(f"run{number}", "silver"))
    return history.run_changes(history.stored_metrics(spark, layout))


GOLD_SQL = {
    "headline": ("fact_order_items", "dim_customers"),
    "monthly_revenue": ("fact_order_items", "dim_date"),
    "revenue_by_state": ("fact_order_items", "dim_customers"),
    "top_categories": ("fact_order_items", "dim_products"),
    "top_cities": ("fact_order_items", "dim_sellers"),
}


def _gold_sql(figure: str) -> Query:
    """A figure as SQL text over gold tables that are written and published in a database of their own."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        layout, tables = Layout(scratch_dir(spark)), Tables(spark, sf_dir)
        for name in GOLD_SQL[figure]:
            write_table(tables.gold(name), layout.table("gold", name))
        database, before = f"martwright_{uuid4().hex}", spark.catalog.currentDatabase()
        publish(spark, layout, "gold", GOLD_SQL[figure], database)
        spark.catalog.setCurrentDatabase(database)
        try:
            return spark.sql(kpi.SQL[figure])
        finally:  # the plan is resolved and reads the folders, which stay
            spark.catalog.setCurrentDatabase(before)
            spark.sql(f"drop database `{database}` cascade")

    return query


def _on_bronze(name: str, plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(Tables(spark, sf_dir).bronze(name))


def _on_suite(plan: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = Tables(spark, sf_dir)
        return plan({name: tables.bronze(name) for name in quality.SUITE})

    return query


def _on_silver(plan: Callable[..., DataFrame], *names: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = Tables(spark, sf_dir)
        return plan(*[tables.silver(name) for name in names])

    return query


def _silver(name: str) -> Query:
    return lambda spark, sf_dir: Tables(spark, sf_dir).silver(name)


def _gold(name: str) -> Query:
    return lambda spark, sf_dir: Tables(spark, sf_dir).gold(name)


def _kpi(plan: Callable[..., DataFrame], dimension: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tables = Tables(spark, sf_dir)
        return plan(tables.silver("orders"), tables.silver("order_items"), tables.gold(dimension))

    return query


QUERIES: dict[str, Query] = {
    "bronze_csv_ingest": bronze_csv_ingest,
    "bronze_contract_ingest": bronze_contract_ingest,
    "silver_trim_strings": _on_bronze("customers", trim_strings),
    "silver_generic_clean": _on_bronze("sellers", generic_clean),
    "schema_check": schema_check,
    **{f"silver_{name}": _silver(name) for name in DATASETS},
    "silver_run_metrics": silver_run_metrics,
    "silver_run_summary": silver_run_summary,
    "silver_run_failures": silver_run_failures,
    "silver_failed_rewrite": silver_failed_rewrite,
    "silver_merged": silver_merged,
    "silver_stream": silver_stream,
    "bronze_rejected": bronze_rejected,
    **{f"gold_{name}": _gold(name) for name in jobs.GOLD_TABLES},
    "gold_dim_calendar": _on_silver(gold.dim_calendar, "orders"),
    "gold_dim_products_spread": dim_products_spread,
    "gold_fact_orders_chunked": _chunked("fact_orders"),
    "gold_fact_order_items_chunked": _chunked("fact_order_items"),
    "gold_fact_orders_colocated": _colocated(gold.fact_orders, "orders", "order_items", "payments"),
    "kpi_monthly_revenue_colocated": _colocated(kpi.monthly_revenue, "orders", "order_items"),
    "run_history": run_history,
    "rule_history": rule_history,
    "quality_references": lambda spark, sf_dir: quality.reference_report(
        {name: Tables(spark, sf_dir).bronze(name) for name in DATASETS}
    ),
    "fact_fanout_audit": _on_silver(gold.fanout_audit, "orders", "order_items", "payments"),
    "quality_report": _on_suite(quality.report),
    "quality_duplicate_keys": _on_suite(quality.duplicate_report),
    "quality_summary": _on_suite(lambda tables: quality.summary(quality.report(tables))),
    "quality_record_counts": record_counts,
    "quality_report_written": lambda spark, sf_dir: _written_report(spark, sf_dir).drop("validation_time"),
    "quality_failure_messages": lambda spark, sf_dir: quality.failure_messages(_written_report(spark, sf_dir)),
    "kpi_headline": _kpi(kpi.headline, "dim_customers"),
    "kpi_monthly_revenue": _on_silver(kpi.monthly_revenue, "orders", "order_items"),
    "kpi_revenue_by_state": _kpi(kpi.revenue_by_state, "dim_customers"),
    "kpi_top_categories": _kpi(kpi.top_categories, "dim_products"),
    "kpi_top_cities": _kpi(kpi.top_cities, "dim_sellers"),
    **{f"gold_sql_{figure}": _gold_sql(figure) for figure in GOLD_SQL},
}
