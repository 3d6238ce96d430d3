import glob
import os
import re

import pytest

from martwright.__main__ import main
from martwright.plans import jobs, kpi
from martwright.plans.datasets import DATASETS
from martwright.session import scan_bytes_for, shuffle_partitions_for, sized_session
from martwright.sources import scratch
from martwright.sources.layout import Layout, publish, read_table, stored_bytes, write_table
from martwright.sources.versions import folder_of
from martwright.testing.queries import Tables
from tests.conftest import rows

RAW = {
    "customers": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
    "c1,u1,01409,rio,RJ\nc1,u1,01409, rio ,RJ\nc2,u2,1,sp,SP\n",
    "geolocation": "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n"
    "01409,-23.5,-46.6,rio,RJ\n",
    "order_items": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
    "o1,1,p1,s1,2017-09-19 09:45:35,58.90,13.29\no1,2,p1,s1,2017-09-19 09:45:35,1.10,0\n"
    "o2,1,p2,s1,2017-09-19 09:45:35,-4,1\n",
    "orders": "order_id,customer_id,order_status,order_purchase_timestamp\n"
    "o1,c1,delivered,2017-09-13 08:59:02\no2,c2,lost,2017-10-13 08:59:02\n",
    "payments": "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
    "o1,1,boleto,1,50\no1,2,voucher,1,23.29\n",
    "products": "product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,"
    "product_weight_g,product_length_cm,product_height_cm,product_width_cm\np1,perfumaria,4,5,1,225,16,10,14\n",
    "reviews": 'review_id,order_id,review_score,review_comment_message\nr1,o1,5,"two\nlines"\nr2,o1,9,\n',
    "sellers": "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,13023, campinas,SP\n",
    "categories": "product_category_name,product_category_name_english\nperfumaria,perfumery\n",
}


@pytest.fixture
def layout(tmp_path):
    out = Layout(str(tmp_path))
    for name, text in RAW.items():
        folder = tmp_path / "raw" / name
        folder.mkdir(parents=True)
        (folder / DATASETS[name].raw_file).write_text(text)
    return out


def test_raw_to_sql(spark, layout):
    bronze = {row.dataset: row for row in jobs.run_bronze(spark, layout).collect()}
    assert {row.status for row in bronze.values()} == {"SUCCESS"}
    assert bronze["reviews"].rows_after == 2

    metrics = jobs.run_silver(spark, layout)
    assert [row.dataset for row in metrics.collect()] == list(DATASETS)
    assert rows(metrics.where("dataset in ('customers', 'order_items')").drop("duration")) == [
        ("customers", 3, 2, 1, "SUCCESS"), ("order_items", 3, 2, 1, "SUCCESS")
    ]
    assert rows(jobs.run_summary(metrics)) == [(9, 9, 0, 16, 13, 3)]

    counts = {row.dataset: row for row in jobs.check_record_counts(spark, layout).collect()}
    assert {row.status for row in counts.values()} == {"PASS"}
    assert (counts["reviews"].bronze_rows, counts["reviews"].silver_rows) == (2, 1)

    assert {row.status for row in jobs.run_gold(spark, layout).collect()} == {"SUCCESS"}
    assert read_table(spark, layout.table("gold", "fact_orders")).count() == 5

    jobs.publish_gold(spark, layout, database="shop")
    jobs.publish_gold(spark, layout, database="shop")
    spark.sql("use shop")
    try:
        assert [(r.category, str(r.revenue)) for r in spark.sql(kpi.SQL["top_categories"]).collect()] == [
            ("perfumery", "60.00")
        ]
    finally:
        spark.sql("use default")
        spark.sql("drop database shop cascade")
    assert read_table(spark, layout.table("gold", "fact_orders")).count() == 5


def test_inferred_types_go_through_all_layers(spark, layout):
    """Prices are doubles, zip prefixes lose their zeros, a record with a line break falls apart."""
    jobs.run_bronze(spark, layout, infer=True)
    assert dict(read_table(spark, layout.table("bronze", "order_items")).dtypes)["price"] == "double"
    assert read_table(spark, layout.table("bronze", "reviews")).count() == 3
    metrics = jobs.run_silver(spark, layout)
    assert rows(metrics.select("status").distinct()) == [("SUCCESS",)]
    assert rows(metrics.where("dataset = 'customers'").select("rows_after")) == [(2,)]
    assert rows(jobs.run_gold(spark, layout).select("status").distinct()) == [("SUCCESS",)]
    items = [read_table(spark, layout.table("silver", name)) for name in ("orders", "order_items")]
    assert [str(row.revenue) for row in kpi.monthly_revenue(*items).collect()] == ["60.00", "0.00"]


def test_facts_may_be_stored_by_month(spark, layout):
    jobs.run_bronze(spark, layout)
    jobs.run_silver(spark, layout)
    metrics = jobs.run_gold(spark, layout, partition_facts=True)
    assert rows(metrics.where("dataset = 'fact_orders'").select("rows_after", "status")) == [(5, "SUCCESS")]
    assert os.path.isdir(folder_of(spark, layout.table("gold", "fact_orders")) + "/order_year=2017/order_month=9")
    jobs.publish_gold(spark, layout, database="shop")
    try:
        assert spark.sql("select count(*) from shop.fact_orders").first()[0] == 5
        september = spark.sql("select * from shop.fact_orders where order_year = 2017 and order_month = 9")
        assert september.count() == 4
        assert re.search(r"PartitionFilters: \[[^]]*order_month", september._jdf.queryExecution().toString())
    finally:
        spark.sql("drop database shop cascade")


@pytest.fixture
def shop(spark):
    spark.sql("create database shop")
    yield "shop"
    spark.sql("drop database shop cascade")


def test_publishing_leaves_other_tables_alone(spark, layout, shop, tmp_path):
    jobs.run_bronze(spark, layout)
    jobs.run_silver(spark, layout)
    jobs.run_gold(spark, layout)
    spark.range(3).write.saveAsTable("shop.dim_sellers")
    foreign = str(tmp_path / "foreign")
    spark.range(4).write.parquet(foreign)
    spark.catalog.createTable("shop.dim_date", path=foreign, source="parquet")
    for name in ("dim_sellers", "dim_date"):
        with pytest.raises(ValueError, match=f"`shop`.`{name}`"):
            publish(spark, layout, "gold", ["dim_customers", name], "shop")
    assert not spark.catalog.tableExists("shop.dim_customers")
    assert spark.table("shop.dim_sellers").count() == 3 and spark.table("shop.dim_date").count() == 4


def test_published_tables_follow_what_is_written(spark, layout, shop):
    path = layout.table("gold", "dim_sellers")
    write_table(spark.range(3), path)
    publish(spark, layout, "gold", ["dim_sellers"], shop)
    write_table(spark.range(5), path)
    publish(spark, layout, "gold", ["dim_sellers"], shop)
    assert spark.table("shop.dim_sellers").count() == 5
    write_table(spark.range(5).selectExpr("id", "id as more"), path)
    with pytest.raises(ValueError, match="other columns"):
        publish(spark, layout, "gold", ["dim_sellers"], shop)


def test_a_view_is_not_published_over(spark, layout):
    write_table(spark.range(3), layout.table("gold", "dim_sellers"))
    spark.range(1).createOrReplaceTempView("dim_sellers")
    try:
        with pytest.raises(ValueError, match="dim_sellers"):
            publish(spark, layout, "gold", ["dim_sellers"])
    finally:
        spark.catalog.dropTempView("dim_sellers")


def test_a_table_is_replaced_as_a_whole(spark, tmp_path, conf):
    conf("spark.sql.sources.partitionOverwriteMode", "dynamic")
    path = str(tmp_path / "t")
    assert write_table(spark.range(6).selectExpr("id", "id % 3 as p"), path, partition_by=["p"]) == 6
    assert write_table(spark.range(2).selectExpr("id", "id % 3 as p"), path, partition_by=["p"]) == 2
    assert write_table(spark.range(4).selectExpr("id"), path) == 4
    assert read_table(spark, path).columns == ["id"]


def test_quality_report_is_one_csv_file_per_run(spark, layout):
    jobs.run_bronze(spark, layout)
    report = jobs.run_quality(spark, layout, "20200101_000000")
    files = glob.glob(layout.report("20200101_000000") + "*.csv")
    assert len(files) == 1
    assert open(files[0]).readline().strip() == "dataset,failed_rows,rule,status,validation_time"
    assert report.count() == 26
    assert rows(report.where("status = 'FAIL'").select("dataset", "rule", "failed_rows")) == [
        ("customers", "Duplicate check: ['customer_id']", 1),
        ("order_items", "Negative value check: price", 1),
        ("orders", "Invalid order status", 1),
        ("reviews", "Invalid review score", 1),
    ]


def test_failures_stay_with_their_dataset(spark, layout):
    jobs.run_bronze(spark, layout)
    jobs.run_silver(spark, layout)
    write_table(spark.range(3), layout.table("bronze", "sellers"))
    metrics = jobs.run_silver(spark, Layout(layout.root), datasets=["sellers", "nowhere", "orders"])
    assert rows(metrics.drop("duration")) == [
        ("nowhere", None, None, None, "FAILED"),
        ("orders", 2, 2, 0, "SUCCESS"),
        ("sellers", 0, 0, 0, "SCHEMA FAILED"),
    ]
    assert rows(jobs.run_summary(metrics)) == [(3, 1, 2, 2, 2, 0)]
    # the earlier table of the skipped dataset is still there
    assert read_table(spark, layout.table("silver", "sellers")).count() == 1


def test_silver_of_silver_is_silver(spark, tmp_path):
    layout = Layout(str(tmp_path))
    Tables(spark, "/root/testdata/sf0.001").write_bronze(layout)
    jobs.run_silver(spark, layout)
    for name in DATASETS:
        once = read_table(spark, layout.table("silver", name))
        again = jobs.silver(name, once)
        assert once.exceptAll(again).isEmpty() and again.exceptAll(once).isEmpty(), name
        key = DATASETS[name].key or tuple(once.columns)
        assert once.groupBy(*key).count().where("count > 1").isEmpty(), name


def test_command_line(spark, layout, conf, capsys):
    conf("spark.sql.shuffle.partitions", "8")
    conf("spark.sql.files.maxPartitionBytes", "128MB")
    stages = ["bronze", "silver", "gold", "quality", "references", "counts", "history", "publish"]
    assert main(["--root", layout.root, *stages]) == 0
    out = capsys.readouterr().out
    assert "Reference check: customer_id in customers" in out and "FIRST CHECK" in out
    assert "customers - Duplicate check: ['customer_id']: 1" in out
    assert spark.sql("select count(*) from fact_orders").first()[0] == 5
    for name in jobs.GOLD_TABLES:
        spark.sql(f"drop table {name}")
    runs = spark.read.parquet(layout.root + "/run-metrics")
    assert rows(runs.groupBy("stage", "status").count()) == [
        ("bronze", "SUCCESS", 9), ("gold", "SUCCESS", 7), ("silver", "SUCCESS", 9)
    ]
    assert rows(spark.read.parquet(layout.root + "/quality-metrics").drop("run_id")) == [(4, 0, 26)]


def test_partitions_follow_the_input_size(spark, layout):
    assert shuffle_partitions_for(0, 8) == 8
    assert shuffle_partitions_for(2**40, 4000) == 2 * 2**40 // 2**27
    assert shuffle_partitions_for(100 * 2**40, 5000) == 50_000
    assert scan_bytes_for(2**40) == 2**27
    assert scan_bytes_for(100 * 2**40) == 100 * 2**40 // 200_000
    assert scan_bytes_for(10**18) == 2**30
    assert stored_bytes(spark, layout.root + "/raw/orders") == len(RAW["orders"])


def test_sizes_are_those_of_a_table(spark, layout, conf):
    conf("spark.sql.session.timeZone", "Asia/Tokyo")
    small, large = sized_session(spark, 0), sized_session(spark, 2**40)
    assert small.conf.get("spark.sql.shuffle.partitions") == str(spark.sparkContext.defaultParallelism)
    assert large.conf.get("spark.sql.shuffle.partitions") == str(2 * 2**40 // 2**27)
    assert small.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    jobs.run_bronze(spark, layout)
    jobs.run_silver(spark, layout)
    tables = jobs.stored_tables(spark, layout, "silver", ["orders", "order_items"])
    assert len({id(t.sparkSession) for t in tables.values()}) == 1 and tables["orders"].sparkSession is not spark
    assert kpi.monthly_revenue(**tables).count() == 2


def test_quality_and_counts_survive_bad_tables(spark, layout):
    jobs.run_bronze(spark, layout, datasets=[name for name in DATASETS if name != "sellers"])
    write_table(read_table(spark, layout.table("bronze", "order_items")).drop("price").limit(2), layout.root + "/x/")
    write_table(read_table(spark, layout.root + "/x/"), layout.table("bronze", "order_items"))
    report = jobs.run_quality(spark, layout, "20200101_000000")
    assert report.count() == 26
    assert rows(report.where("status = 'NOT CHECKED'").select("dataset", "rule", "failed_rows")) == [
        ("order_items", "Negative value check: price", None),
        ("sellers", "Duplicate check: ['seller_id']", None),
        ("sellers", "Null check: seller_id", None),
    ]
    assert rows(jobs.quality.summary(report)) == [(3, 3, 26)]
    assert ("sellers - Null check: seller_id: not checked",) in rows(jobs.quality.failure_messages(report))
    jobs.run_silver(spark, layout, datasets=["customers", "orders"])
    counts = {r.dataset: (r.bronze_rows, r.silver_rows, r.status) for r in jobs.check_record_counts(spark, layout).collect()}
    assert counts["orders"] == (2, 2, "PASS") and counts["sellers"] == (None, None, "NOT CHECKED")
    assert counts["order_items"] == (2, None, "NOT CHECKED") and len(counts) == 9
    assert main(["--root", layout.root, "quality", "counts"]) == 0
    nothing = Layout(layout.root + "/nothing")
    assert {r.status for r in jobs.run_quality(spark, nothing, "r").collect()} == {"NOT CHECKED"}


class FakeSession:
    def __init__(self, shared, master):
        self.conf = {"spark.checkpoint.dir": shared} if shared else {}
        self.sparkContext = type("Context", (), {"master": master})


def test_scratch_folder_follows_the_session():
    assert scratch.scratch_path(FakeSession("/shared/", "yarn")).startswith("/shared/martwright-")
    assert os.path.isdir(scratch.scratch_path(FakeSession(None, "local[2]")))
    with pytest.raises(RuntimeError):
        scratch.scratch_path(FakeSession(None, "yarn"))


def test_scratch_tables_go_with_the_driver(spark):
    path = scratch.scratch_dir(spark)
    assert write_table(spark.range(3), path) == 3
    folder, files = scratch._folder(spark, os.path.dirname(path))
    assert files.cancelDeleteOnExit(folder)
    files.delete(folder, True)


def test_scratch_folder_is_removed(spark):
    with scratch.scratch(spark) as folder:
        write_table(spark.range(3), folder + "/t")
        assert os.path.isdir(folder + "/t")
    assert not os.path.exists(folder)
