"""Headline business figures over the silver tables and gold dimensions.

Revenue is the sum of item prices over the items of known orders, whatever their status; orders
without items count as orders. The plans sum before they join where they can, so that a busy order,
customer, product or seller reaches a join as a single row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martwright.functions.calendar import date_attributes, purchase_date
from martwright.functions.columns import money

AMOUNT = "decimal(38,2)"


def order_revenue(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Every order with the sum of its item prices, NULL if it has none."""
    sums = order_items.groupBy("order_id").agg(F.sum(money("price")).alias("revenue"))
    return orders.select("order_id", "customer_id", "order_purchase_timestamp").join(sums, "order_id", "left")


def headline(orders: DataFrame, order_items: DataFrame, customers: DataFrame) -> DataFrame:
    """Total revenue, orders, customers and average order value, in one row.

    The two totals meet by a union of one-row aggregates rather than by a join without a key.
    """
    sales = order_revenue(orders, order_items).agg(
        F.coalesce(F.sum("revenue"), F.lit(0)).cast(AMOUNT).alias("total_revenue"),
        F.count(F.lit(1)).alias("total_orders"),
    )
    people = customers.agg(F.count_distinct("customer_unique_id").alias("total_customers"))
    return (
        sales.unionByName(people, allowMissingColumns=True)
        .agg(*[F.max(name).alias(name) for name in ("total_revenue", "total_orders", "total_customers")])
        .withColumn(
            "average_order_value",
            F.round(F.expr("try_divide(total_revenue, cast(total_orders as decimal(20,0)))"), 2).cast(AMOUNT),
        )
    )


def monthly_revenue(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Revenue and orders per calendar month in order; orders of unknown date form a NULL month.

    Sums per date come first: the calendar attributes are then worked out once per date.
    """
    daily = (
        order_revenue(orders, order_items)
        .groupBy(purchase_date())
        .agg(F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    )
    return (
        daily.select("revenue", "orders", *date_attributes())
        .groupBy("year", "month", "month_name")
        .agg(
            F.coalesce(F.sum("revenue"), F.lit(0)).cast(AMOUNT).alias("revenue"),
            F.sum("orders").alias("orders"),
        )
        .orderBy(F.col("year").asc_nulls_first(), F.col("month").asc_nulls_first())
    )


def revenue_by_state(orders: DataFrame, order_items: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue per customer state; orders of unknown customers form the NULL state."""
    per_customer = (
        order_revenue(orders, order_items).groupBy("customer_id").agg(F.sum("revenue").alias("revenue"))
    )
    return (
        per_customer.join(customers.select("customer_id", "customer_state"), "customer_id", "left")
        .groupBy("customer_state")
        .agg(F.coalesce(F.sum("revenue"), F.lit(0)).cast(AMOUNT).alias("revenue"))
    )


def top_categories(orders: DataFrame, order_items: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` categories with most revenue, by English name where there is one."""
    named = products.select(
        "product_id", F.coalesce("product_category_name_english", "product_category_name").alias("category")
    )
    return _top(_sold(orders, order_items, "product_id").join(named, "product_id", "left"), "category", n)


def top_cities(orders: DataFrame, order_items: DataFrame, sellers: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` seller cities with most revenue."""
    places = sellers.select("seller_id", "seller_city")
    return _top(_sold(orders, order_items, "seller_id").join(places, "seller_id", "left"), "seller_city", n)


def _sold(orders: DataFrame, order_items: DataFrame, column: str) -> DataFrame:
    """Revenue per value of an item column, over the items of known orders."""
    known = order_items.join(orders.select("order_id"), "order_id", "left_semi")
    return (
        known.where(F.col("price").isNotNull())
        .groupBy(column)
        .agg(F.sum(money("price")).alias("revenue"))
    )


def _top(sold: DataFrame, column: str, n: int) -> DataFrame:
    return (
        sold.groupBy(column)
        .agg(F.sum("revenue").cast(AMOUNT).alias("revenue"))
        .orderBy(F.col("revenue").desc(), F.col(column).asc_nulls_first())
        .limit(n)
    )


# The same figures as SQL text over the published gold tables.
SQL = {
    "headline": """
        with sales as (
            select cast(coalesce(sum(price), 0) as decimal(38,2)) as total_revenue,
                   count(distinct order_id) as total_orders
            from fact_order_items
        ), people as (
            select count(distinct customer_unique_id) as total_customers from dim_customers
        )
        select total_revenue, total_orders, (select total_customers from people) as total_customers,
               cast(round(try_divide(total_revenue, cast(total_orders as decimal(20,0))), 2) as decimal(38,2))
                   as average_order_value
        from sales
    """,
    "monthly_revenue": """
        with daily as (
            select to_date(order_purchase_timestamp) as date, sum(price) as revenue,
                   count(distinct order_id) as orders
            from fact_order_items group by to_date(order_purchase_timestamp)
        )
        select d.year, d.month, d.month_name,
               cast(coalesce(sum(revenue), 0) as decimal(38,2)) as revenue, sum(orders) as orders
        from daily join dim_date d on daily.date <=> d.date
        group by d.year, d.month, d.month_name
        order by d.year nulls first, d.month nulls first
    """,
    "revenue_by_state": """
        with buyers as (
            select customer_id, sum(price) as revenue from fact_order_items group by customer_id
        )
        select c.customer_state, cast(coalesce(sum(revenue), 0) as decimal(38,2)) as revenue
        from buyers left join dim_customers c on buyers.customer_id = c.customer_id
        group by c.customer_state
    """,
    "top_categories": """
        with sold as (
            select product_id, sum(price) as revenue from fact_order_items
            where price is not null group by product_id
        )
        select coalesce(p.product_category_name_english, p.product_category_name) as category,
               cast(sum(revenue) as decimal(38,2)) as revenue
        from sold left join dim_products p on sold.product_id = p.product_id
        group by 1 order by revenue desc, category nulls first limit 10
    """,
    "top_cities": """
        with sold as (
            select seller_id, sum(price) as revenue from fact_order_items
            where price is not null group by seller_id
        )
        select s.seller_city, cast(sum(revenue) as decimal(38,2)) as revenue
        from sold left join dim_sellers s on sold.seller_id = s.seller_id
        group by 1 order by revenue desc, seller_city nulls first limit 10
    """,
}
