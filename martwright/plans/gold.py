"""Silver to gold: four dimensions and the facts."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, functions as F

from martwright.functions.calendar import date_attributes, purchase_date
from martwright.functions.columns import money
from martwright.operators.clean import smallest_per_key
from martwright.operators.hitters import NONE, Hitters, heavy_hitters
from martwright.operators.joins import CHUNK_ROWS, Details, left_join_details, left_join_lookup, oversized_keys

# The columns of the product dimension and of the wide fact, in their order.
DIM_PRODUCTS = (
    "product_id",
    "product_category_name",
    "product_category_name_english",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
)
FACT_ORDERS = (
    "order_id",
    "customer_id",
    "product_id",
    "seller_id",
    "order_purchase_timestamp",
    "order_status",
    "price",
    "freight_value",
    "payment_value",
)


# Names of the detail tables that hold oversized orders, as a mapping with these orders.
Oversized = Collection[str] | Mapping[str, Collection | None]


def dim_customers(customers: DataFrame) -> DataFrame:
    rows = customers.select("customer_id", "customer_unique_id", "customer_city", "customer_state")
    return smallest_per_key(rows, ["customer_id"])


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return smallest_per_key(sellers.select("seller_id", "seller_city", "seller_state"), ["seller_id"])


def dim_products(products: DataFrame, categories: DataFrame, hitters: Hitters = NONE) -> DataFrame:
    """Products with the English category name, NULL where there is no translation.

    ``hitters`` are the categories that hold many products (see ``category_hitters``); they do not change the rows.

    A category with several translations would repeat its products, and the deduplication would
    keep the smallest translation. Both sides are reduced before the join instead, which gives the
    same rows without the fan-out.
    """
    own = [column for column in DIM_PRODUCTS if column != "product_category_name_english"]
    rows = smallest_per_key(products.select(*own), ["product_id"])
    translation = smallest_per_key(
        categories.select("product_category_name", "product_category_name_english"), ["product_category_name"]
    )
    joined = left_join_lookup(rows, translation, "product_category_name", spread="product_id", hitters=hitters)
    return joined.select(*DIM_PRODUCTS)


def category_hitters(products: DataFrame, tasks: int) -> Hitters:
    """The categories that would fill several of so many tasks; runs a job, best on a stored table."""
    return heavy_hitters(products, "product_category_name", tasks)


def dim_date(orders: DataFrame) -> DataFrame:
    """The dates that occur, with their attributes; unknown purchase times give one all-NULL row."""
    return orders.select(purchase_date()).distinct().select("date", *date_attributes())


def dim_calendar(orders: DataFrame) -> DataFrame:
    """Every date from the first to the last purchase, with its attributes, whether or not it occurs.

    Only the first and last date leave the tasks that read orders; the days between are generated from that row.
    """
    ends = orders.agg(F.min(purchase_date()).alias("first"), F.max(purchase_date()).alias("last"))
    days = ends.where(F.col("first").isNotNull()).select(F.explode(F.sequence("first", "last")).alias("date"))
    return days.select("date", *date_attributes())


def fact_orders(
    orders: DataFrame,
    order_items: DataFrame,
    payments: DataFrame,
    oversized: Oversized = (),
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The wide fact: every item of an order beside every payment of it.

    Items and payments hang on the order independently, so an order with *m* items and *n* payments
    has *m x n* rows and sums over them overcount. That is what this table holds; sums belong on
    ``fact_order_items`` and ``fact_order_payments``.

    ``oversized`` names those of order_items and payments in which one order may hold more rows than
    a task should join (see ``oversized_details``).
    """
    parts = {"order_items": _items(order_items), "payments": _payments(payments)}
    return _with_details(orders, parts, oversized, chunk_rows).select(*FACT_ORDERS)


def fact_order_items(
    orders: DataFrame, order_items: DataFrame, oversized: Oversized = (), chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """One row per order item, and one for an order without items."""
    return _with_details(orders, {"order_items": _items(order_items)}, oversized, chunk_rows).select(
        "order_id",
        "order_item_id",
        "customer_id",
        "product_id",
        "seller_id",
        "order_purchase_timestamp",
        "order_status",
        "price",
        "freight_value",
    )


def oversized_details(
    order_items: DataFrame | None = None, payments: DataFrame | None = None, chunk_rows: int = CHUNK_ROWS
) -> dict[str, list | None]:
    """Which of the given tables hold orders that are too large for one task, and these orders.

    None stands for all orders with sequence numbers from ``chunk_rows`` on. Runs jobs, best on stored tables.
    """
    parts = {}
    if order_items is not None:
        parts["order_items"] = _items(order_items)
    if payments is not None:
        parts["payments"] = _payments(payments)
    found = oversized_keys(list(parts.values()), "order_id", chunk_rows)
    return {list(parts)[i]: keys for i, keys in found.items()}


def _with_details(orders: DataFrame, parts: dict[str, Details], oversized: Oversized, chunk_rows: int) -> DataFrame:
    keys = oversized if isinstance(oversized, Mapping) else dict.fromkeys(oversized)
    cut = {i: keys[name] for i, name in enumerate(parts) if name in keys}
    return left_join_details(_order_header(orders), "order_id", list(parts.values()), cut, chunk_rows)


def fact_order_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per order: number of payments and the amount paid."""
    paid = payments.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("payments"), F.sum(money("payment_value")).alias("payment_value")
    )
    return (
        _order_header(orders)
        .join(paid, "order_id", "left")
        .select(
            "order_id",
            "customer_id",
            "order_purchase_timestamp",
            "order_status",
            F.coalesce("payments", F.lit(0)).cast("bigint").alias("payments"),
            F.col("payment_value").cast("decimal(28,2)").alias("payment_value"),
        )
    )


def fanout_audit(orders: DataFrame, order_items: DataFrame, payments: DataFrame) -> DataFrame:
    """Per order: what ``fact_orders`` holds for it, and how far its price sum overshoots.

    Both totals come from per-order aggregates; the multiplied rows are never produced.
    """
    items = order_items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("items"), F.sum(money("price")).alias("revenue")
    )
    paid = payments.groupBy("order_id").agg(F.count(F.lit(1)).alias("payments"))
    counted = (
        orders.select("order_id")
        .join(items, "order_id", "left")
        .join(paid, "order_id", "left")
        .select(
            "order_id",
            F.coalesce("items", F.lit(0)).alias("items"),
            F.coalesce("payments", F.lit(0)).alias("payments"),
            F.coalesce("revenue", F.lit(0)).cast("decimal(28,2)").alias("revenue"),
        )
    )
    copies = F.greatest("payments", F.lit(1))
    return counted.select(
        "order_id",
        F.col("items").cast("bigint").alias("items"),
        F.col("payments").cast("bigint").alias("payments"),
        (F.greatest("items", F.lit(1)) * copies).cast("bigint").alias("fact_rows"),
        "revenue",
        (F.col("revenue") * copies).cast("decimal(38,2)").alias("fact_revenue"),
    )


def _order_header(orders: DataFrame) -> DataFrame:
    return orders.select("order_id", "customer_id", "order_purchase_timestamp", "order_status")


def _items(order_items: DataFrame) -> Details:
    return Details(
        order_items.select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"),
        "order_item_id",
    )


def _payments(payments: DataFrame) -> Details:
    return Details(payments.select("order_id", "payment_sequential", "payment_value"), "payment_sequential")
