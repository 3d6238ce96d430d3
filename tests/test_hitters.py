"""Heavy hitters of a key, and the joins that are led by them."""

import pytest
from pyspark.sql import functions as F

from martwright.operators.hitters import NONE, Hitters, heavy_hitters, pieces
from martwright.operators.joins import Details, left_join_details, left_join_lookup, oversized_keys
from martwright.plans import gold
from tests.conftest import rows
from tests.test_plans import exchanges, hot_products, plan


def skewed(spark, n=30_000):
    """A third of the rows on one key, a tenth without one, the others on some 2 000."""
    key = "case when id % 3 = 0 then 'hot' when id % 10 = 1 then null else concat('k', id % 2000) end"
    return spark.range(n).selectExpr("id", f"{key} as k")


def test_what_is_found(spark):
    found = heavy_hitters(skewed(spark).repartition(7), "k", 100)
    assert found.values == ["hot"] and found.counts[0][1] == 10_000
    assert (found.rows, found.missing, found.missing_is_heavy) == (30_000, 2_000, True)
    assert found.share(10_000) == 64 and found.share(1) == 1
    assert not heavy_hitters(spark.range(1000).selectExpr("id % 50 as k"), "k", 40).any
    assert not heavy_hitters(spark.range(0).selectExpr("id as k"), "k", 40).any
    nothing = heavy_hitters(spark.range(50).selectExpr("cast(null as string) as k"), "k", 40)
    assert nothing.values == [] and nothing.missing_is_heavy


def test_counters_that_overflow_lose_no_heavy_value(spark):
    """Far more values than counters, over many partitions."""
    many = spark.range(200_000).selectExpr("case when id % 20 = 0 then -1 when id % 20 = 1 then -2 else id end as `a key`")
    found = heavy_hitters(many.repartition(16), "a key", 100)
    assert sorted(found.values) == [-2, -1]


@pytest.mark.parametrize("counts", [(), (("hot", 10_000),), (("hot", 10_000), ("k7", 300), ("never", 9))])
@pytest.mark.parametrize("missing", [0, 9_000])
def test_hitters_do_not_change_a_lookup(spark, counts, missing):
    data = skewed(spark, 6_000)
    table = spark.range(2_500).selectExpr("if(id = 0, 'hot', concat('k', id)) as k", "id * 2 as v")
    hitters = Hitters(30_000, missing, counts, 100)
    out = left_join_lookup(data, table, "k", "id", hitters)
    assert out.columns == ["k", "id", "v"]
    assert rows(out) == rows(data.join(table, "k", "left"))


def test_even_keys_cost_what_the_plain_join_costs(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    data, table = spark.range(100).selectExpr("id", "id as k"), spark.range(100).selectExpr("id as k", "id as v")
    assert "__salt" not in plan(left_join_lookup(data, table, "k", "id"))
    assert exchanges(left_join_lookup(data, table, "k", "id", NONE)) == 2


def test_only_heavy_rows_of_the_table_are_repeated(spark):
    hitters = Hitters(30_000, 0, (("hot", 10_000),), 100)
    copies = spark.createDataFrame([("hot",), ("k1",), (None,)], "k string").select("k", pieces(F.col("k"), hitters).alias("n"))
    assert rows(copies) == [("hot", 64), ("k1", 1), (None, 1)]
    assert rows(copies.select(pieces(F.col("k"), NONE))) == [(1,)] * 3


def test_a_hot_key_is_bounded_without_adaptive_execution(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.shuffle.partitions", "64")
    products = hot_products(spark, 60_000)
    categories = spark.createDataFrame(
        [("hot", "HOT"), ("c1", "C1")], "product_category_name string, product_category_name_english string"
    )
    hitters = gold.category_hitters(products, 64)
    assert hitters.values == ["hot"] and hitters.missing_is_heavy
    out = gold.dim_products(products, categories, hitters)
    assert out.where("product_category_name_english = 'HOT'").count() == 20_000
    sizes = [row["count"] for row in out.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 60_000 and max(sizes) < 60_000 / 8


def test_only_oversized_orders_are_cut(spark):
    """An order with high numbers but few rows is joined as it is."""
    items = [(1, n, 0) for n in range(60)] + [(2, 900 + n, 0) for n in range(3)] + [(3, 1, 0)]
    part = Details(spark.createDataFrame(items, "order_id int, item int, price int"), "item")
    head = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "order_id int, name string")
    found = oversized_keys([part], "order_id", 10)
    assert set(found) == {0} and 1 in found[0] and 3 not in found[0]
    expected = rows(head.join(part.rows, "order_id", "left"))
    for cut in (found, {0: [1]}, {0: None}, {0: []}, [0], []):
        assert rows(left_join_details(head, "order_id", [part], cut, 10)) == expected
    assert oversized_keys([part], "order_id", 1000) == {}
