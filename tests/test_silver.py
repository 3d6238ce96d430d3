import datetime as dt
import math
from decimal import Decimal

import pytest

from martwright.plans.datasets import DATASETS
from martwright.plans.silver import missing_columns, silver
from tests.conftest import rows

ITEMS = "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double"


def table(spark, name, data, **types):
    spec = DATASETS[name]
    ddl = ", ".join(f"{column} {types.get(column, kind)}" for column, kind in spec.required.items())
    return spark.createDataFrame(data, ddl)


def test_customers(spark):
    out = silver("customers", table(spark, "customers", [
        ("c1", "u1", "01409", " rio ", "RJ"),
        ("c1", "u1", "01409", "rio", "RJ"),
        (" c1", "u0", "01409", "rio", "RJ"),
        (None, "u2", "1", "x", "SP"),
        ("c3", None, "1", "x", "SP"),
        ("", "u4", "1", "x", "SP"),
        (None, None, None, None, None),
    ]))
    assert rows(out) == [("", "u4", "1", "x", "SP"), ("c1", "u0", "01409", "rio", "RJ")]


def test_orders_keep_unknown_times_but_not_unknown_status(spark):
    when = dt.datetime(2018, 1, 2, 3, 4, 5)
    out = silver("orders", table(spark, "orders", [
        ("o1", "c1", "lost", when),
        ("o2", "c1", "shipped", None),
        ("o3", "c1", None, when),
        ("o4", None, "shipped", when),
        (None, "c1", "shipped", when),
        ("o5", "c1", "  ", when),
    ]))
    assert rows(out) == [("o1", "c1", "lost", when), ("o2", "c1", "shipped", None), ("o5", "c1", "", when)]


def test_a_key_goes_with_its_failing_survivor(spark):
    """The smallest row is chosen first; a valid twin does not step in for it."""
    data = [("o1", 1, "p", "s", -5.0, 1.0), ("o1", 1, "p", "s", 5.0, 1.0), ("o2", 1, "p", "s", 5.0, 1.0)]
    out = silver("order_items", spark.createDataFrame(data, ITEMS))
    assert rows(out) == [("o2", 1, "p", "s", 5.0, 1.0)]


def test_order_item_rules(spark):
    data = [
        ("o1", 1, "p", "s", 0.0, 1.0),
        ("o2", 1, "p", "s", None, 1.0),
        ("o3", 1, "p", "s", 1.0, -0.0),
        ("o4", 1, "p", "s", 1.0, -0.1),
        ("o5", 1, "p", "s", math.nan, 0.0),
        ("o6", 1, None, "s", 1.0, 0.0),
        ("o7", 1, "p", None, 1.0, 0.0),
        (None, 1, "p", "s", 1.0, 0.0),
        ("o8", None, "p", "s", 1.0, 0.0),
    ]
    out = silver("order_items", spark.createDataFrame(data, ITEMS))
    assert sorted(row.order_id for row in out.collect()) == ["o3", "o5", "o8"]


def test_malformed_numbers_count_as_null(spark):
    data = [("o1", 1, "p", "s", "abc", "1"), ("o2", 1, "p", "s", " 2.5 ", "0"), ("o3", 1, "p", "s", "0.4", "x")]
    df = table(spark, "order_items", data, price="string", freight_value="string")
    assert rows(silver("order_items", df)) == [("o2", 1, "p", "s", "2.5", "0")]


def test_payments_keep_one_row_per_null_key(spark):
    out = silver("payments", table(spark, "payments", [
        (None, 1, "boleto", 2, Decimal("5.00")),
        (None, 1, "boleto", 1, Decimal("7.00")),
        (None, None, None, None, None),
        (None, None, "card", 1, Decimal("1.00")),
        ("o1", 1, "card", 0, Decimal("1.00")),
        ("o2", 1, "card", 1, Decimal("0.00")),
        ("o3", 1, "card", 1, Decimal("-1.00")),
    ]))
    assert rows(out) == [(None, 1, "boleto", 1, Decimal("7.00")), (None, None, "card", 1, Decimal("1.00"))]


def test_reviews_are_filtered_before_the_deduplication(spark):
    out = silver("reviews", table(spark, "reviews", [
        ("r1", "o0", 0), ("r1", "o1", 5), ("r1", "o2", 4), ("r2", "o1", 6), ("r3", "o1", None), (None, "o9", 1),
        (None, "o8", 1),
    ]))
    assert rows(out) == [("r1", "o1", 5), (None, "o8", 1)]


def test_products_need_positive_measures(spark):
    good = ("p1", "c", 1, 1, 1, 1, 1, 1, 1)
    data = [good] + [good[:i] + (bad,) + good[i + 1:] for i in range(5, 9) for bad in (0, -1, None)]
    data = [data[0]] + [(f"q{i}",) + row[1:] for i, row in enumerate(data[1:])]
    data.append((None,) + good[1:])
    assert rows(silver("products", table(spark, "products", data))) == sorted([good, (None,) + good[1:]], key=repr)


def test_sellers(spark):
    data = [("s1", "1", " rio", "RJ"), ("s1", "1", "rio", "RJ"), (None, "1", "x", "SP")]
    assert rows(silver("sellers", table(spark, "sellers", data))) == [("s1", "1", "rio", "RJ")]


def test_categories_are_distinct_after_trimming(spark):
    data = [("a", "A"), ("a ", "A"), ("a", "B"), ("b", None), (None, "C"), ("", "")]
    assert rows(silver("categories", table(spark, "categories", data))) == [("", ""), ("a", "A"), ("a", "B")]


def test_geolocation(spark):
    data = [("01", 1.0, 2.0, "b", "SP"), ("01", 1.0, 2.0, "a", "SP"), ("01", None, 2.0, "a", "SP"),
            (None, 1.0, 2.0, "a", "SP"), ("01", 0.0, 2.0, "z", "SP"), ("01", -0.0, 2.0, "y", "SP")]
    out = silver("geolocation", table(spark, "geolocation", data))
    assert rows(out) == sorted(
        [("01", 1.0, 2.0, "a", "SP"), ("01", None, 2.0, "a", "SP"), ("01", 0.0, 2.0, "y", "SP")], key=repr
    )


def test_further_columns_pass_through(spark):
    data = [("r1", "o1", 5, "  hi "), ("r1", "o1", 5, "zz")]
    df = spark.createDataFrame(data, "review_id string, order_id string, review_score int, note string")
    assert rows(silver("reviews", df)) == [("r1", "o1", 5, "hi")]


@pytest.mark.parametrize("name", DATASETS)
def test_empty_table(spark, name):
    out = silver(name, table(spark, name, []))
    assert out.count() == 0
    assert out.columns == list(DATASETS[name].required)


def test_missing_columns_are_matched_in_case(spark):
    df = spark.createDataFrame([(1, 2)], "review_id int, Order_ID int")
    assert missing_columns("reviews", df) == ["order_id", "review_score"]
    assert missing_columns("reviews", df.selectExpr("review_id", "order_id as order_id", "1 as review_score")) == []
