"""Rejected records, resumed jobs, co-located tables, relations and the history of runs."""

import json

import pytest
from pyspark.sql import functions as F

from martwright.__main__ import main
from martwright.plans import gold, history, jobs, kpi, quality
from martwright.plans.datasets import DATASETS
from martwright.sources import versions
from martwright.sources.layout import Layout, read_table, write_table
from martwright.testing.queries import Tables
from tests.conftest import rows
from tests.test_jobs import RAW, layout  # noqa: F401
from tests.test_plans import exchanges, plan

SF = "/root/testdata/sf0.001"

BAD = {
    "payments": "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
    "o1,1,boleto,1,50\no1,two,boleto,one,5\no2,1,boleto,1\no3,1,boleto,1,1,1\no4,1,,,\n",
    "reviews": 'review_id,order_id,review_score,review_comment_message\nr1,o1,5,"two\nlines"\nr2,o1,good,"a ""quoted""\n,word"\n',
}


@pytest.fixture
def dirty(layout, tmp_path):  # noqa: F811
    for name, text in BAD.items():
        (tmp_path / "raw" / name / DATASETS[name].raw_file).write_text(text)
    return layout


@pytest.mark.parametrize("strict", [False, True])
def test_rejected_records_are_kept_with_their_reasons(spark, dirty, strict):
    metrics = {r.dataset: r for r in jobs.run_bronze(spark, dirty, strict=strict).collect()}
    assert (metrics["payments"].rows_before, metrics["payments"].rows_after) == (5, 2 if strict else 5)
    rejected = read_table(spark, dirty.table("rejected", "payments"))
    assert rows(rejected.select("record", "reasons")) == [
        ("o1,two,boleto,one,5", ["payment_sequential: no int: two", "payment_installments: no int: one"]),
        ("o2,1,boleto,1", ["another number of fields"]),
        ("o3,1,boleto,1,1,1", ["another number of fields"]),
    ]
    assert rejected.select("file").first()[0].endswith(DATASETS["payments"].raw_file)
    review = read_table(spark, dirty.table("rejected", "reviews")).first()
    assert review.record == 'r2,o1,good,"a ""quoted""\n,word"' and review.reasons == ["review_score: no int: good"]
    assert read_table(spark, dirty.table("rejected", "customers")).count() == 0
    kept = read_table(spark, dirty.table("bronze", "payments"))
    assert kept.columns == list(DATASETS["payments"].required)
    if not strict:
        assert ("o1", None, "boleto", None) in rows(kept.select(*kept.columns[:4]))


def test_mended_files_empty_the_quarantine(spark, dirty, tmp_path):
    jobs.run_bronze(spark, dirty)
    (tmp_path / "raw" / "payments" / DATASETS["payments"].raw_file).write_text(RAW["payments"])
    jobs.run_bronze(spark, dirty, ["payments"])
    assert read_table(spark, dirty.table("rejected", "payments")).count() == 0


def numbers(spark, layout, layer, names):  # noqa: F811
    return {name: versions.current(spark, layout.table(layer, name)).number for name in names}


def test_a_killed_run_goes_on_where_it_was(spark, layout, tmp_path, monkeypatch):  # noqa: F811
    jobs.run_bronze(spark, layout, ["orders", "customers"])
    write = jobs.write_table

    def killed(df, path, *args, **options):
        if "silver/customers" in path:
            raise KeyboardInterrupt
        return write(df, path, *args, **options)

    monkeypatch.setattr(jobs, "write_table", killed)
    with pytest.raises(KeyboardInterrupt):
        jobs.run_silver(spark, layout, ["orders", "customers"], workers=1)
    monkeypatch.undo()
    metrics = jobs.run_silver(spark, layout, ["orders", "customers"], resume=True)
    assert rows(metrics.select("dataset", "rows_before", "rows_after", "status")) == [
        ("customers", 3, 2, "SUCCESS"), ("orders", 2, 2, "UNCHANGED")
    ]
    assert rows(jobs.run_summary(metrics)) == [(2, 2, 0, 5, 4, 1)]


def test_resumed_jobs_redo_what_depends_on_a_change(spark, layout, tmp_path):  # noqa: F811
    def run():
        found = [jobs.run_bronze(spark, layout, resume=True), jobs.run_silver(spark, layout, resume=True)]
        found.append(jobs.run_gold(spark, layout, resume=True))
        return [{r.dataset: r.status for r in metrics.collect()} for metrics in found]

    assert {status for stage in run() for status in stage.values()} == {"SUCCESS"}
    assert {status for stage in run() for status in stage.values()} == {"UNCHANGED"}
    (tmp_path / "raw" / "categories" / DATASETS["categories"].raw_file).write_text(RAW["categories"] + "beleza,beauty\n")
    bronze, silver, facts = run()
    assert {k for k, v in bronze.items() if v == "SUCCESS"} == {k for k, v in silver.items() if v == "SUCCESS"} == {"categories"}
    assert {k for k, v in facts.items() if v == "SUCCESS"} == {"dim_products"}
    # other settings are another table
    redone = jobs.run_gold(spark, layout, ["fact_orders", "dim_sellers"], partition_facts=True, resume=True)
    assert rows(redone.select("dataset", "status")) == [("dim_sellers", "SUCCESS"), ("fact_orders", "SUCCESS")]


def test_command_line_resumes(spark, layout, conf, capsys):  # noqa: F811
    conf("spark.sql.shuffle.partitions", "8")
    conf("spark.sql.files.maxPartitionBytes", "128MB")
    for _ in range(2):
        assert main(["--root", layout.root, "--resume", "--strict", "bronze", "silver"]) == 0
    assert "UNCHANGED" in capsys.readouterr().out


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    found = Layout(str(tmp_path_factory.mktemp("stored")))
    Tables(spark, SF).write_bronze(found)
    jobs.run_silver(spark, found)
    return found


def test_co_located_tables_are_joined_without_a_shuffle(spark, stored, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    tables = jobs.stored_tables(spark, stored, "silver", ["orders", "order_items", "payments"])
    for table in tables.values():
        table.sparkSession.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    orders, items = tables["orders"], tables["order_items"]
    for joined in (gold.fact_orders(**tables), gold.fact_order_items(orders, items), kpi.order_revenue(orders, items)):
        assert exchanges(joined) == 0, plan(joined)
    assert exchanges(gold.fact_order_payments(orders, tables["payments"])) == 0
    plain = {name: spark.read.parquet(versions.folder_of(spark, stored.table("silver", name))) for name in tables}
    assert rows(gold.fact_orders(**tables)) == rows(gold.fact_orders(**plain))
    assert rows(kpi.monthly_revenue(orders, items)) == rows(kpi.monthly_revenue(plain["orders"], plain["order_items"]))


def test_a_table_with_a_hot_order_is_not_dealt_by_it(spark, tmp_path):
    found = Layout(str(tmp_path))
    tables = Tables(spark, SF)
    items = tables.bronze("order_items")
    hot = items.limit(1).select("order_id").first()[0]
    more = spark.range(100, 9_100).selectExpr(f"{hot}L as order_id", "cast(id as int) as order_item_id")
    wide = items.unionByName(more.select("*", *[F.lit(1).cast(items.schema[c].dataType).alias(c) for c in items.columns[2:]]))
    write_table(wide, found.table("bronze", "order_items"))
    write_table(tables.bronze("orders"), found.table("bronze", "orders"))
    jobs.run_silver(spark, found, ["orders", "order_items"])
    assert versions.current(spark, found.table("silver", "order_items")).buckets == 0
    assert versions.current(spark, found.table("silver", "orders")).buckets >= 8


def test_relations(spark):
    parent = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "id string")
    child = spark.createDataFrame([("a",), ("x",), ("x",), ("y",), (None,)], "id string")
    references = [
        quality.Reference("child", "id", "parent", "id"),
        quality.Reference("parent", "id", "parent", "id"),
        quality.Reference("child", "other", "parent", "id"),
        quality.Reference("child", "id", "nowhere", "id"),
    ]
    found = quality.reference_report({"child": child, "parent": parent}, references)
    assert rows(found.select("dataset", "rule", "failed_rows", "failed_keys", "status")) == [
        ("child", "Reference check: id in nowhere", None, None, "NOT CHECKED"),
        ("child", "Reference check: id in parent", 3, 2, "FAIL"),
        ("child", "Reference check: other in parent", None, None, "NOT CHECKED"),
        ("parent", "Reference check: id in parent", 0, 0, "PASS"),
    ]


def test_calendar_without_orders_and_with_one(spark):
    orders = spark.createDataFrame([("2018-02-27",), ("2018-03-02",), (None,)], "d string")
    orders = orders.selectExpr("cast(d as timestamp_ntz) as order_purchase_timestamp")
    assert rows(gold.dim_calendar(orders).select(F.col("date").cast("string"))) == [
        ("2018-02-27",), ("2018-02-28",), ("2018-03-01",), ("2018-03-02",)
    ]
    assert gold.dim_calendar(orders.where("order_purchase_timestamp is null")).collect() == []


def test_rule_history(spark):
    table = [
        ("r1", "o", "a", "FAIL", 3), ("r2", "o", "a", "NOT CHECKED", None), ("r3", "o", "a", "FAIL", 5),
        ("r4", "o", "a", "PASS", 0), ("r5", "o", "a", "PASS", 0), ("r6", "o", "a", "FAIL", 1),
        ("r1", "o", "b", "PASS", 0), ("r2", "o", "b", "FAIL", 9),
    ]
    reports = spark.createDataFrame(table, "run_id string, dataset string, rule string, status string, failed_rows bigint")
    found = history.rule_changes(reports).select("rule", "run_id", "trend", "rows_change", "failing_since")
    assert rows(found) == [
        ("a", "r1", "FIRST CHECK", None, "r1"),
        ("a", "r2", None, None, None),
        ("a", "r3", "STILL FAILING", 2, "r1"),
        ("a", "r4", "MENDED", -5, None),
        ("a", "r5", "PASS", 0, None),
        ("a", "r6", "NEWLY FAILING", 1, "r6"),
        ("b", "r1", "FIRST CHECK", None, None),
        ("b", "r2", "NEWLY FAILING", 9, "r2"),
    ]


def test_run_history(spark):
    table = [
        ("r1", "SUCCESS", 100), ("r2", "FAILED", None), ("r3", "FAILED", None), ("r4", "SUCCESS", 150),
        ("r5", "SCHEMA FAILED", 0), ("r6", "UNCHANGED", 150), ("r7", "SUCCESS", 0), ("r8", "SUCCESS", 5),
    ]
    metrics = spark.createDataFrame(table, "run_id string, status string, rows_after bigint")
    metrics = metrics.withColumns({"stage": F.lit("silver"), "dataset": F.lit("orders")})
    found = history.run_changes(metrics).select("run_id", "rows_change", "percent_change", "status_change", "runs_in_status")
    assert [(a, b, None if c is None else str(c), d, e) for a, b, c, d, e in rows(found)] == [
        ("r1", None, None, None, 1),
        ("r2", None, None, True, 1),
        ("r3", None, None, False, 2),
        ("r4", 50, "50.00", True, 1),
        ("r5", None, None, True, 1),
        ("r6", 0, "0.00", True, 1),
        ("r7", -150, "-100.00", True, 1),
        ("r8", 5, None, False, 2),
    ]


def test_commit_records_say_what_a_table_was_made_from(spark, layout):  # noqa: F811
    jobs.run_bronze(spark, layout, ["orders"])
    jobs.run_silver(spark, layout, ["orders"])
    found = versions.current(spark, layout.table("silver", "orders"))
    source = layout.table("bronze", "orders")
    assert found.made_from[source] == versions.fingerprint(spark, source) and json.dumps(found.made_from)
