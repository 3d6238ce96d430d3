"""What the physical plans must look like."""

import re

import pytest
from pyspark.sql import functions as F

from martwright.operators.clean import smallest_per_key
from martwright.operators.hitters import Hitters
from martwright.operators.joins import Details, _beyond_first
from martwright.plans import gold, kpi, quality
from martwright.plans.datasets import DATASETS
from martwright.plans.silver import silver
from martwright.sources.layout import Layout, read_table
from martwright.testing import queries
from martwright.testing.queries import QUERIES, Tables


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    layout = Layout(str(tmp_path_factory.mktemp("plans")))
    Tables(spark, "/root/testdata/sf0.001").write_bronze(layout)
    return layout


@pytest.fixture
def bronze(spark, layout, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    return lambda name: read_table(spark, layout.table("bronze", name))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"\bExchange ", plan(df)))


@pytest.mark.parametrize("name", DATASETS)
def test_silver_shuffles_once(bronze, name):
    assert exchanges(silver(name, bronze(name))) == 1


@pytest.mark.parametrize("name", ["customers", "orders", "order_items", "sellers", "geolocation"])
def test_key_rules_reach_the_scan(bronze, name):
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan(silver(name, bronze(name)).limit(1))).group(1)
    assert f"IsNotNull({DATASETS[name].key[0]})" in pushed


def test_deduplication_keeps_one_row_of_a_key_before_it_shuffles(bronze):
    text = plan(smallest_per_key(bronze("payments"), ["order_id", "payment_sequential"]))
    above, below = text.split("Exchange ", 1)
    assert re.search(r"WindowGroupLimit .* Partial", below) and re.search(r"WindowGroupLimit .* Final", above)


def test_wide_fact_shuffles_each_input_once(spark, bronze):
    wide = gold.fact_orders(bronze("orders"), bronze("order_items"), bronze("payments"))
    assert exchanges(wide) == 3
    assert "order_item_id" not in plan(wide)


def test_facts_and_figures_are_planned_without_a_job(spark, bronze):
    """Orders give the figures their ids only."""
    sales, products, sellers = (bronze("orders"), bronze("order_items")), bronze("products"), bronze("sellers")
    categories, payments = bronze("categories"), bronze("payments")
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        frames = [
            gold.fact_orders(*sales, payments),
            gold.fact_orders(*sales, payments, {"order_items", "payments"}),
            gold.fact_order_items(*sales),
            kpi.top_categories(*sales, gold.dim_products(products, categories)),
            kpi.top_cities(*sales, sellers),
        ]
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for figure in frames[-2:]:
        assert "order_id" in plan(figure) and "customer_id" not in plan(figure) and "LeftSemi" in plan(figure)


def test_oversized_orders_are_looked_for_by_a_pushed_filter(bronze):
    part = Details(bronze("order_items"), "order_item_id")
    text = plan(_beyond_first(part, 50).select("order_item_id"))
    assert "GreaterThanOrEqual(order_item_id,50)" in text
    assert "ReadSchema: struct<order_item_id:int>" in text


def test_gold_dimension_reuses_the_silver_partitioning(bronze):
    assert exchanges(gold.dim_customers(silver("customers", bronze("customers")))) == 1
    assert exchanges(gold.dim_sellers(silver("sellers", bronze("sellers")))) == 1


def test_joins_get_summed_rows_and_needed_columns_only(bronze):
    df = kpi.revenue_by_state(bronze("orders"), bronze("order_items"), bronze("customers"))
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
    columns = {tuple(re.findall(r"(\w+):", schema)) for schema in schemas}
    assert columns == {("order_id", "customer_id"), ("order_id", "price"), ("customer_id", "customer_state")}
    assert "CartesianProduct" not in plan(df) and "NestedLoop" not in plan(df)


@pytest.mark.parametrize("name", quality.SUITE)
def test_quality_scans_once_for_all_predicates(bronze, name):
    rules = quality.SUITE[name]
    text = plan(quality.report({name: bronze(name)}, {name: rules}))
    keyed = sum(1 for rule in rules if rule.unique)
    assert text.count("FileScan") == 1 + keyed
    assert text.count("Exchange hashpartitioning") == keyed


def test_no_query_joins_without_a_key(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    tables = Tables(spark, "/root/testdata/sf0.001")
    sales = tables.silver("orders"), tables.silver("order_items")
    for df in (
        kpi.headline(*sales, tables.gold("dim_customers")),
        kpi.top_categories(*sales, tables.gold("dim_products")),
        kpi.top_cities(*sales, tables.gold("dim_sellers")),
        tables.gold("fact_orders"),
        QUERIES["gold_sql_monthly_revenue"](spark, "/root/testdata/sf0.001"),
    ):
        assert "CartesianProduct" not in plan(df) and "NestedLoop" not in plan(df)


def hot_products(spark, count):
    """A third of the products share a category, another third have none."""
    return spark.range(count).selectExpr(
        "concat('p', id) as product_id",
        "case id % 3 when 0 then 'hot' when 1 then concat('c', id) end as product_category_name",
        "1 as product_weight_g", "cast(id as int) as product_length_cm", "1 as product_height_cm",
        "1 as product_width_cm",
    )


def test_a_hot_category_is_spread_over_tasks(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "64")
    categories = spark.createDataFrame(
        [("hot", "HOT"), ("hot", "WARM"), ("c1", "C1")],
        "product_category_name string, product_category_name_english string",
    )
    products = hot_products(spark, 60_000)
    out = gold.dim_products(products, categories, gold.category_hitters(products, 64))
    assert out.where("product_category_name_english = 'HOT'").count() == 20_000
    assert out.where("product_category_name_english is null").count() == 39_999
    sizes = [row["count"] for row in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 60_000 and max(sizes) < 60_000 / 8


def test_adaptive_execution_splits_what_is_still_too_large(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2000")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else one map task reads all of this little
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "4000")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.shuffle.partitions", "200")
    categories = spark.createDataFrame(
        [("hot", "HOT")], "product_category_name string, product_category_name_english string"
    )
    few_pieces = Hitters(60_000, 20_000, (("hot", 20_000),), tasks=12)
    out = gold.dim_products(hot_products(spark, 60_000), categories, few_pieces)
    assert len(out.collect()) == 60_000
    assert "skew=true" in plan(out)


@pytest.mark.parametrize("fact", ["fact_orders", "fact_order_items"])
def test_chunked_facts_read_written_silver_tables(spark, fact):
    """The silver rows are looked over and joined several times, so they are made once."""
    files = QUERIES[f"gold_{fact}_chunked"](spark, "/root/testdata/sf0.001").inputFiles()
    assert files and all("/silver/" in name for name in files)


def inputs_of(monkeypatch, name, place):
    """The input files of the frames that a query hands to one of its functions."""
    found, function = [], getattr(queries, name)

    def noted(*args, **settings):
        found.append(args[place].inputFiles())
        return function(*args, **settings)

    monkeypatch.setattr(queries, name, noted)
    return found


def test_runs_of_the_rule_history_start_from_the_first(spark, monkeypatch):
    """The test tables are shaped once; the cleaned and the doubled rows come from the table that the first run checked."""
    found = inputs_of(monkeypatch, "write_table", 0)
    QUERIES["rule_history"](spark, "/root/testdata/sf0.001")
    assert len(found) == 3 * len(quality.SUITE)
    assert all("/bronze/" in name for files in found[len(quality.SUITE) :] for name in files)


def test_batches_are_shaped_once(spark, monkeypatch):
    found = inputs_of(monkeypatch, "apply_batch", 3)
    QUERIES["silver_merged"](spark, "/root/testdata/sf0.001")
    assert len(found) == queries.BATCHES * len(queries.MERGED)
    assert all("/landed/" in name for files in found for name in files)
