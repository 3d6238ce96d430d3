import datetime as dt
from decimal import Decimal

from martwright.plans import gold
from martwright.testing.shapes import Shapes
from martwright.plans.silver import silver
from tests.conftest import rows

SF = "/root/testdata/sf0.001"


def products(spark, data):
    return spark.createDataFrame(
        [(p, c, 1, 2, 3, 4) for p, c in data],
        "product_id string, product_category_name string, product_weight_g int, product_length_cm int, "
        "product_height_cm int, product_width_cm int",
    )


def categories(spark, data):
    return spark.createDataFrame(data, "product_category_name string, product_category_name_english string")


def test_dim_products_keeps_untranslated_products(spark):
    out = gold.dim_products(
        products(spark, [("p1", "a"), ("p2", "unknown"), ("p3", None)]), categories(spark, [("a", "A"), ("x", "X")])
    )
    assert [row[:3] for row in rows(out)] == [("p1", "a", "A"), ("p2", "unknown", None), ("p3", None, None)]
    assert out.columns == [
        "product_id", "product_category_name", "product_category_name_english", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm",
    ]


def test_two_translations_give_one_product_with_the_smaller(spark):
    out = gold.dim_products(products(spark, [("p1", "a")]), categories(spark, [("a", "Z"), ("a", "B")]))
    assert [row[:3] for row in rows(out)] == [("p1", "a", "B")]


def test_dims_deduplicate_input_that_is_not_silver(spark):
    out = gold.dim_products(products(spark, [("p1", "b"), ("p1", "a")]), categories(spark, [("a", "A")]))
    assert [row[:3] for row in rows(out)] == [("p1", "a", "A")]
    sellers = spark.createDataFrame(
        [("s", "1", "b", "X"), ("s", "2", "a", "Y")],
        "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
    )
    assert rows(gold.dim_sellers(sellers)) == [("s", "a", "Y")]
    customers = spark.createDataFrame(
        [("c", "u2", "z", "a", "X"), ("c", "u1", "z", "b", "Y")],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, "
        "customer_state string",
    )
    assert rows(gold.dim_customers(customers)) == [("c", "u1", "b", "Y")]


def test_dim_date_attributes(spark):
    times = [
        dt.datetime(2018, 12, 31, 23, 59), dt.datetime(2018, 12, 31), dt.datetime(2016, 2, 29), None, None,
        dt.datetime(2021, 1, 3),
    ]
    orders = spark.createDataFrame([(t,) for t in times], "order_purchase_timestamp timestamp_ntz")
    out = gold.dim_date(orders)
    assert out.columns == ["date", "day", "month", "month_name", "quarter", "year", "week", "weekday"]
    assert rows(out) == sorted(
        [
            (None,) * 8,
            (dt.date(2016, 2, 29), 29, 2, "February", 1, 2016, 9, "Monday"),
            (dt.date(2018, 12, 31), 31, 12, "December", 4, 2018, 1, "Monday"),
            (dt.date(2021, 1, 3), 3, 1, "January", 1, 2021, 53, "Sunday"),
        ],
        key=repr,
    )


def facts(spark):
    when = dt.datetime(2018, 1, 1)
    orders = spark.createDataFrame(
        [("o1", "c1", "s", when), ("o2", "c2", "s", when), ("o3", "c3", "s", None)],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp_ntz",
    )
    items = spark.createDataFrame(
        [("o1", 1, "p", "s", Decimal("1.00"), Decimal("0.10")), ("o1", 2, "q", "s", Decimal("2.00"), Decimal("0.20")),
         ("o9", 1, "p", "s", Decimal("9.00"), Decimal("0.90"))],
        "order_id string, order_item_id int, product_id string, seller_id string, price decimal(18,2), "
        "freight_value decimal(18,2)",
    )
    payments = spark.createDataFrame(
        [("o1", n, "card", 1, Decimal(n)) for n in (1, 2, 3)] + [("o2", 1, "card", 1, Decimal("5.00"))],
        "order_id string, payment_sequential int, payment_type string, payment_installments int, "
        "payment_value decimal(18,2)",
    )
    return orders, items, payments


def test_fact_orders_multiplies_items_and_payments(spark):
    out = gold.fact_orders(*facts(spark))
    assert out.columns == [
        "order_id", "customer_id", "product_id", "seller_id", "order_purchase_timestamp", "order_status", "price",
        "freight_value", "payment_value",
    ]
    counts = {row.order_id: row["count"] for row in out.groupBy("order_id").count().collect()}
    assert counts == {"o1": 6, "o2": 1, "o3": 1}


def test_fanout_audit_agrees_with_the_wide_fact(spark):
    orders, items, payments = facts(spark)
    audit = {row.order_id: row for row in gold.fanout_audit(orders, items, payments).collect()}
    assert (audit["o1"].items, audit["o1"].payments, audit["o1"].fact_rows) == (2, 3, 6)
    assert (audit["o1"].revenue, audit["o1"].fact_revenue) == (Decimal("3.00"), Decimal("9.00"))
    assert (audit["o3"].items, audit["o3"].fact_rows, audit["o3"].revenue) == (0, 1, Decimal("0.00"))


def test_single_grain_facts(spark):
    orders, items, payments = facts(spark)
    assert sorted((r.order_id, r.order_item_id or 0) for r in gold.fact_order_items(orders, items).collect()) == [
        ("o1", 1), ("o1", 2), ("o2", 0), ("o3", 0)
    ]
    paid = {r.order_id: (r.payments, r.payment_value) for r in gold.fact_order_payments(orders, payments).collect()}
    assert paid == {"o1": (3, Decimal("6.00")), "o2": (1, Decimal("5.00")), "o3": (0, None)}


def test_wide_fact_row_count_on_the_test_tables(spark):
    shapes = Shapes(spark, SF)
    tables = {name: silver(name, shapes.bronze(name)) for name in ("orders", "order_items", "payments")}
    wide = gold.fact_orders(*tables.values()).count()
    assert wide == gold.fanout_audit(*tables.values()).agg({"fact_rows": "sum"}).first()[0]
