"""

Each prints one line per variant with the seconds of every run, the two variants in turn. ``BENCH_CPUS`` is the number of
local cores, ``BENCH_ROWS`` the rows of the generated inputs, ``BENCH_SF_DIR`` the folder of the Parquet tables.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession, functions as F  # noqa: E402

from martwright.operators.clean import smallest_per_key, trim_strings  # noqa: E402
from martwright.operators.hitters import heavy_hitters  # noqa: E402
from martwright.operators.joins import left_join_lookup  # noqa: E402
from martwright.plans import gold, jobs, quality  # noqa: E402
from martwright.plans.datasets import DATASETS  # noqa: E402
from martwright.plans.silver import silver  # noqa: E402
from martwright.session import build_session  # noqa: E402
from martwright.sources.layout import Layout, read_table, write_table  # noqa: E402
from martwright.testing.queries import Tables  # noqa: E402

CPUS = os.environ.get("BENCH_CPUS", "8")
ROWS = int(os.environ.get("BENCH_ROWS", "12000000"))
RUNS = 3


def noop(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def compare(title: str, variants: dict[str, Callable[[], None]], runs: int = RUNS) -> None:
    seconds: dict[str, list[float]] = {name: [] for name in variants}
    for _ in range(runs):
        for name, work in variants.items():
            started = time.perf_counter()
            work()
            seconds[name].append(round(time.perf_counter() - started, 2))
    for name, taken in seconds.items():
        print(f"{title} | {name} | best {min(taken)} s | {taken}", flush=True)


def stepwise(spark: SparkSession, folder: str) -> None:
    """Silver and quality with one action per step, against the jobs."""
    layout = Layout(folder)
    Tables(spark, os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")).write_bronze(layout)

    def silver_in_steps() -> None:
        for name, spec in DATASETS.items():
            rows = read_table(spark, layout.table("bronze", name))
            clean = trim_strings(rows.distinct().na.drop(how="all"))
            clean = clean.dropDuplicates(list(spec.key)) if spec.key else clean.distinct()
            rows.count()
            clean.count()
            clean.write.mode("overwrite").parquet(f"{folder}/steps/{name}")

    def quality_in_steps() -> None:
        for name, rules in quality.SUITE.items():
            table = read_table(spark, layout.table("bronze", name))
            for rule in rules:
                if rule.unique:
                    table.groupBy(*rule.unique).count().where("count > 1").count()
                else:
                    table.where(rule.fails(table)).count()

    tables = {name: read_table(spark, layout.table("bronze", name)) for name in quality.SUITE}
    variants = {
        "steps": silver_in_steps,
        "job, one table at a time": lambda: jobs.run_silver(spark, layout, workers=1),
        "job, four at a time": lambda: jobs.run_silver(spark, layout),
    }
    compare("silver, 9 tables", variants)
    compare("quality, 26 rules", {"steps": quality_in_steps, "report": lambda: quality.report(tables).collect()})


def dedup(spark: SparkSession, folder: str) -> None:
    """A2: aggregate against window, on text ids, with wide rows and with a hot key."""
    inputs = {
        "hexadecimal ids": "md5(cast(id % {n} as string))",
        "hot key": "md5(cast(if(id % 3 = 0, 0, id % {n}) as string))",
    }
    for title, key in inputs.items():
        path = f"{folder}/{title.replace(' ', '-')}"
        wide = [f"concat('value {i} of ', cast(id % 1000 as string)) as c{i}" for i in range(8)]
        spark.range(ROWS).selectExpr(key.format(n=ROWS * 9 // 10) + " as k", "id", *wide).write.parquet(path)
        rows = spark.read.parquet(path)
        rest = F.struct(*[c for c in rows.columns if c != "k"])
        compare(
            f"keyed deduplication, {ROWS} rows, {title}",
            {
                "aggregate": lambda rows=rows, rest=rest: noop(rows.groupBy("k").agg(F.min(rest))),
                "window": lambda rows=rows: noop(smallest_per_key(rows, ["k"])),
            },
        )


def lookup(spark: SparkSession, folder: str) -> None:
    """J1: the lookup led by measured hitters, the measuring included, against the plain left join; without broadcast, and a
    third of the rows on one key."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    for title, key in {"even": "id % 100000", "hot key": "if(id % 3 = 0, 0, id % 100000)"}.items():
        path = f"{folder}/{title.replace(' ', '-')}"
        spark.range(ROWS).selectExpr("id", f"cast({key} as string) as k", "md5(cast(id as string)) as v").write.parquet(path)
        rows = spark.read.parquet(path)
        table = spark.range(100_000).selectExpr("cast(id as string) as k", "id as w")
        compare(
            f"lookup join, {ROWS} rows, {title}",
            {
                "measured": lambda rows=rows, table=table: noop(
                    left_join_lookup(rows, table, "k", "id", heavy_hitters(rows, "k", 64))
                ),
                "plain": lambda rows=rows, table=table: noop(rows.join(table, "k", "left")),
            },
        )


def skew(spark: SparkSession, folder: str) -> None:
    """Order items, a third of them in one order: silver, quality rules and the item fact."""
    items = spark.range(ROWS).selectExpr(
        "if(id % 3 = 0, 'hot', md5(cast(id div 4 as string))) as order_id",
        "cast(if(id % 3 = 0, id div 3, id % 4) as int) as order_item_id",
        "md5(cast(id % 30000 as string)) as product_id",
        "md5(cast(id % 3000 as string)) as seller_id",
        "cast(1 + id % 100 as decimal(18,2)) as price",
        "cast(1 as decimal(18,2)) as freight_value",
    )
    write_table(items, f"{folder}/items")
    items = read_table(spark, f"{folder}/items")
    orders = items.selectExpr("order_id", "'c' as customer_id", "'delivered' as order_status").distinct()
    write_table(orders.withColumn("order_purchase_timestamp", F.expr("timestamp_ntz'2018-01-01 00:00:00'")), f"{folder}/orders")
    orders = read_table(spark, f"{folder}/orders")
    oversized = gold.oversized_details(order_items=items)
    compare(
        f"{ROWS} order items, a third in one order, oversized: {sorted(oversized)}",
        {
            "silver order_items": lambda: noop(silver("order_items", items)),
            "quality order_items": lambda: quality.report(
                {"order_items": items}, {"order_items": quality.SUITE["order_items"]}
            ).collect(),
            "fact_order_items, cut": lambda: noop(gold.fact_order_items(orders, items, oversized)),
            "fact_order_items, plain": lambda: noop(gold.fact_order_items(orders, items)),
        },
        runs=2,
    )


def main() -> None:
    session = build_session("evidence", f"local[{CPUS}]", spark__driver__memory="8g", spark__sql__shuffle__partitions="64")
    session.sparkContext.setLogLevel("ERROR")
    for name in sys.argv[1:]:
        with tempfile.TemporaryDirectory(prefix="martwright-bench-") as folder:
            {"stepwise": stepwise, "dedup": dedup, "lookup": lookup, "skew": skew}[name](session, folder)


if __name__ == "__main__":
    main()
