"""The queries as SQL for DuckDB, over the same Parquet tables.

Written from the rules rather than from the Spark plans: deduplication is a ``row_number``, every
quality rule is a count of its own, and the wide fact is summed as it stands.
"""

from __future__ import annotations

from martwright.testing.shapes import HELPERS, RAW, SHAPES, TABLES

# Columns per dataset, and which of them are text.
COLUMNS = {
    "customers": (
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ),
    "geolocation": (
        "geolocation_zip_code_prefix",
        "geolocation_lat",
        "geolocation_lng",
        "geolocation_city",
        "geolocation_state",
    ),
    "order_items": (
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "price",
        "freight_value",
    ),
    "orders": (
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
    ),
    "payments": (
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    ),
    "products": (
        "product_id",
        "product_category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
    ),
    "reviews": (
        "review_id",
        "order_id",
        "review_score",
    ),
    "sellers": (
        "seller_id",
        "seller_zip_code_prefix",
        "seller_city",
        "seller_state",
    ),
    "categories": (
        "product_category_name",
        "product_category_name_english",
    ),
}
TEXT = {
    "customer_unique_id",
    "customer_city",
    "customer_state",
    "geolocation_city",
    "geolocation_state",
    "order_status",
    "payment_type",
    "product_category_name",
    "product_category_name_english",
    "seller_city",
    "seller_state",
}

# (key, rule before the deduplication, rule after it)
RULES = {
    "customers": ("customer_id", "true", "customer_id is not null and customer_unique_id is not null"),
    "geolocation": (
        "geolocation_zip_code_prefix, geolocation_lat, geolocation_lng",
        "true",
        "geolocation_zip_code_prefix is not null",
    ),
    "order_items": (
        "order_id, order_item_id",
        "true",
        "order_id is not null and product_id is not null and seller_id is not null "
        "and price > 0 and freight_value >= 0",
    ),
    "orders": ("order_id", "true", "order_id is not null and customer_id is not null and order_status is not null"),
    "payments": ("order_id, payment_sequential", "true", "payment_value > 0 and payment_installments > 0"),
    "products": (
        "product_id",
        "true",
        "product_weight_g > 0 and product_length_cm > 0 and product_height_cm > 0 and product_width_cm > 0",
    ),
    "reviews": ("review_id", "review_score >= 1 and review_score <= 5", "true"),
    "sellers": ("seller_id", "true", "seller_id is not null"),
}


def _trimmed(name: str) -> str:
    return ", ".join(f"trim({c}) as {c}" if c in TEXT else c for c in COLUMNS[name])


def _some_value(name: str) -> str:
    return "(" + " or ".join(f"{c} is not null" for c in COLUMNS[name]) + ")"


def _silver(name: str, source: str = "b") -> str:
    columns = COLUMNS[name]
    if name == "categories":
        return (
            f"select distinct {_trimmed(name)} from {source}_{name} where "
            + " and ".join(f"{c} is not null" for c in columns)
        )
    key, before, after = RULES[name]
    order = ", ".join(f"{c} asc nulls first" for c in columns)
    return f"""
        select {", ".join(columns)} from (
            select *, row_number() over (partition by {key} order by {order}) as rn
            from (select {_trimmed(name)} from {source}_{name} where {_some_value(name)}) where {before}
        ) where rn = 1 and {after}
    """


GOLD = {
    "dim_customers": "select customer_id, customer_unique_id, customer_city, customer_state from s_customers",
    "dim_sellers": "select seller_id, seller_city, seller_state from s_sellers",
    "dim_products": """
        select product_id, product_category_name, product_category_name_english, product_weight_g,
               product_length_cm, product_height_cm, product_width_cm
        from (
            select p.*, c.product_category_name_english,
                   row_number() over (
                       partition by p.product_id
                       order by p.product_category_name asc nulls first,
                                c.product_category_name_english asc nulls first) as rn
            from s_products p left join s_categories c on p.product_category_name = c.product_category_name
        ) where rn = 1
    """,
    "dim_date": """
        select date, cast(day(date) as int) as day, cast(month(date) as int) as month,
               monthname(date) as month_name, cast(quarter(date) as int) as quarter,
               cast(year(date) as int) as year, cast(week(date) as int) as week, dayname(date) as weekday
        from (select distinct cast(order_purchase_timestamp as date) as date from s_orders)
    """,
    "fact_orders": """
        select o.order_id, o.customer_id, oi.product_id, oi.seller_id, o.order_purchase_timestamp, o.order_status,
               oi.price, oi.freight_value, p.payment_value
        from s_orders o left join s_order_items oi on o.order_id = oi.order_id
                        left join s_payments p on o.order_id = p.order_id
    """,
    "fact_order_items": """
        select o.order_id, oi.order_item_id, o.customer_id, oi.product_id, oi.seller_id,
               o.order_purchase_timestamp, o.order_status, oi.price, oi.freight_value
        from s_orders o left join s_order_items oi on o.order_id = oi.order_id
    """,
    "fact_order_payments": """
        select o.order_id, o.customer_id, o.order_purchase_timestamp, o.order_status,
               count(p.order_id) as payments, cast(sum(p.payment_value) as decimal(28,2)) as payment_value
        from s_orders o left join s_payments p on o.order_id = p.order_id
        group by o.order_id, o.customer_id, o.order_purchase_timestamp, o.order_status
    """,
}


def _with(statement: str) -> str:
    """``statement`` preceded by the shapes, silver and gold tables as common table expressions."""
    parts = {name: text for name, text in HELPERS.items()}
    parts |= {f"b_{name}": text for name, text in SHAPES.items()}
    parts |= {f"r_{name}": text for name, text in RAW.items()}
    names = {name: name for name in (*TABLES, *HELPERS, *(f"b_{name}" for name in SHAPES))}
    parts = {name: text.format(**names) for name, text in parts.items()}
    parts |= {f"s_{name}": _silver(name) for name in COLUMNS}
    parts |= {f"x_{name}": f"select * from b_{name} union all select * from b_{name}" for name in COLUMNS}
    parts |= GOLD
    return "with " + ",\n".join(f"{name} as ({text})" for name, text in parts.items()) + "\n" + statement


def _null(table: str, column: str) -> tuple[str, str, str]:
    return table, f"Null check: {column}", f"select count(*) from b_{table} where {column} is null"


def _negative(table: str, column: str) -> tuple[str, str, str]:
    return table, f"Negative value check: {column}", f"select count(*) from b_{table} where {column} < 0"


def _duplicate(table: str, *columns: str) -> tuple[str, str, str]:
    groups = f"select 1 from b_{table} group by {', '.join(columns)} having count(*) > 1"
    return table, f"Duplicate check: {list(columns)}", f"select count(*) from ({groups})"


QUALITY = [
    _duplicate("orders", "order_id"),
    _null("orders", "order_id"),
    _null("orders", "customer_id"),
    _null("orders", "order_purchase_timestamp"),
    (
        "orders",
        "Invalid order status",
        "select count(*) from b_orders where order_status not in ('approved', 'created', 'delivered', 'invoiced', "
        "'processing', 'shipped', 'canceled', 'unavailable')",
    ),
    _duplicate("customers", "customer_id"),
    _null("customers", "customer_id"),
    _null("customers", "customer_unique_id"),
    _duplicate("order_items", "order_id", "order_item_id"),
    _null("order_items", "order_id"),
    _null("order_items", "product_id"),
    _null("order_items", "seller_id"),
    _negative("order_items", "price"),
    _negative("order_items", "freight_value"),
    _null("payments", "order_id"),
    _null("payments", "payment_type"),
    _negative("payments", "payment_value"),
    _negative("payments", "payment_installments"),
    _null("reviews", "review_id"),
    _null("reviews", "order_id"),
    (
        "reviews",
        "Invalid review score",
        "select count(*) from b_reviews where review_score < 1 or review_score > 5",
    ),
    _duplicate("products", "product_id"),
    _null("products", "product_id"),
    _negative("products", "product_weight_g"),
    _duplicate("sellers", "seller_id"),
    _null("sellers", "seller_id"),
]


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _report(source: str = "b") -> str:
    rows = " union all ".join(
        f"select {_text(table)} as dataset, {_text(label)} as rule, ({count.replace('from b_', f'from {source}_')}) as failed_rows"
        for table, label, count in QUALITY
    )
    status = "case when failed_rows = 0 then 'PASS' else 'FAIL' end"
    return f"select dataset, failed_rows, rule, {status} as status from ({rows})"


def _duplicates() -> str:
    prefix = "Duplicate check: "
    return " union all ".join(
        f"select {_text(table)} as dataset, {_text(label.removeprefix(prefix))} as key, ({count}) as duplicate_groups"
        for table, label, count in QUALITY
        if label.startswith(prefix)
    )


def _counts() -> str:
    return " union all ".join(
        f"select '{name}' as dataset, (select count(*) from b_{name}) as bronze_rows, "
        f"(select count(*) from s_{name}) as silver_rows"
        for name in COLUMNS
    )


def _metrics() -> str:
    return (
        "select dataset, bronze_rows as rows_before, silver_rows as rows_after, "
        f"bronze_rows - silver_rows as rows_removed, 'SUCCESS' as status from ({_counts()})"
    )


def _records() -> str:
    columns = COLUMNS | {"reviews": (*COLUMNS["reviews"], "review_comment_title", "review_comment_message")}
    texts = {name: [f"coalesce(cast({c} as varchar), 'NULL')" for c in own] for name, own in columns.items()}
    return " union all ".join(
        f"select '{name}' as dataset, concat_ws('|', {', '.join(own)}) as record from r_{name}" for name, own in texts.items()
    )


# (child, column, parent): the column has the same name in both tables
REFERENCES = [
    ("orders", "customer_id", "customers"),
    ("order_items", "order_id", "orders"),
    ("order_items", "product_id", "products"),
    ("order_items", "seller_id", "sellers"),
    ("payments", "order_id", "orders"),
    ("reviews", "order_id", "orders"),
    ("products", "product_category_name", "categories"),
]


def _references() -> str:
    rows = " union all ".join(
        f"select '{child}' as dataset, 'Reference check: {column} in {parent}' as rule, count(*) as failed_rows, "
        f"count(distinct c.{column}) as failed_keys from b_{child} c where c.{column} is not null "
        f"and not exists (select 1 from b_{parent} p where p.{column} = c.{column})"
        for child, column, parent in REFERENCES
    )
    return f"select *, case when failed_rows = 0 then 'PASS' else 'FAIL' end as status from ({rows})"


def _texts(columns: tuple[str, ...]) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(cast({c} as varchar), 'NULL')" for c in columns) + ")"


def _rejected() -> str:
    bad_installments = "(payment_sequential = 3 and payment_installments is not null)"
    bad_value = "(payment_type = 'boleto' and payment_installments = 2 and payment_value is not null)"
    reasons = (
        f"concat_ws('; ', case when {bad_installments} then 'payment_installments: no int: about ' || payment_installments end, "
        f"case when {bad_value} then 'payment_value: no decimal(18,2): ' || payment_value || 'x' end)"
    )
    bad = f"coalesce({bad_installments}, false) or coalesce({bad_value}, false)"
    reviews = (*COLUMNS["reviews"], "review_comment_title", "review_comment_message")
    four = "coalesce(review_score = 4, false)"
    return f"""
        select 'payments' as dataset, {_texts(COLUMNS["payments"])} as record, 'parsed' as fate
        from r_payments where not ({bad})
        union all select 'payments', {reasons}, 'rejected' from r_payments where {bad}
        union all select 'reviews', {_texts(reviews)}, 'parsed' from r_reviews where not {four}
        union all select 'reviews', 'review_score: no int: four', 'rejected' from r_reviews where {four}
    """


def _merged() -> str:
    return " union all ".join(
        f"select '{name}' as dataset, {_texts(COLUMNS[name])} as record from s_{name}"
        for name in ("customers", "orders", "order_items", "categories")
    )


def _run_history() -> str:
    runs = " union all ".join(
        f"select 'run{number}' as run_id, '{name}' as dataset, "
        + ("'SCHEMA FAILED' as status, 0 as rows_after" if (number, name) == (2, "sellers") else
           f"'SUCCESS' as status, (select count(*) from s_{name}) as rows_after")
        for number in range(1, 5)
        for name in ("customers", "sellers")
    )
    return f"""
        select * from (with runs as ({runs}), written as (
            select a.*, (select b.rows_after from runs b where b.dataset = a.dataset and b.status = 'SUCCESS'
                         and b.run_id < a.run_id order by b.run_id desc limit 1) as last_written,
                   (select b.status from runs b where b.dataset = a.dataset and b.run_id < a.run_id
                    order by b.run_id desc limit 1) as last_status,
                   (select max(b.run_id) from runs b where b.dataset = a.dataset and b.run_id < a.run_id
                    and b.status <> a.status) as last_other
            from runs a
        )
        select run_id, 'silver' as stage, dataset, status, cast(rows_after as bigint) as rows_after,
               case when status = 'SUCCESS' then rows_after - last_written end as rows_change,
               cast(case when status = 'SUCCESS' and last_written > 0
                         then round((rows_after - last_written) * 100.0 / last_written, 2) end as decimal(20,2)) as percent_change,
               status <> last_status as status_change,
               (select count(*) from runs b where b.dataset = w.dataset and b.run_id <= w.run_id
                and b.run_id > coalesce(w.last_other, '')) as runs_in_status
        from written w)
    """


def _rule_history() -> str:
    runs = zip(("20240101_000000", "20240102_000000", "20240103_000000"), ("b", "s", "x"), strict=True)
    reports = " union all ".join(f"select '{run}' as run_id, * from ({_report(source)})" for run, source in runs)
    return f"""
        select * from (with reports as ({reports}), beside as (
            select a.*, b.status as last_status, b.failed_rows as last_rows,
                   (select max(c.run_id) from reports c where c.dataset = a.dataset and c.rule = a.rule
                    and c.run_id < a.run_id and c.status = 'PASS') as last_pass
            from reports a left join reports b on a.dataset = b.dataset and a.rule = b.rule
                 and b.run_id = (select max(c.run_id) from reports c where c.run_id < a.run_id)
        )
        select run_id, dataset, rule, status, failed_rows, failed_rows - last_rows as rows_change,
               case when last_status is null then 'FIRST CHECK' when status = 'FAIL' and last_status = 'FAIL' then 'STILL FAILING'
                    when status = 'FAIL' then 'NEWLY FAILING' when last_status = 'FAIL' then 'MENDED' else 'PASS' end as trend,
               case when status = 'FAIL' then (select min(c.run_id) from reports c where c.dataset = b.dataset
                    and c.rule = b.rule and c.status = 'FAIL' and c.run_id > coalesce(b.last_pass, '')) end as failing_since
        from beside b)
    """


MONTHLY = """
    select cast(year(date) as int) as year, cast(month(date) as int) as month, monthname(date) as month_name,
           cast(coalesce(sum(price), 0) as decimal(38,2)) as revenue, count(distinct order_id) as orders
    from (select *, cast(order_purchase_timestamp as date) as date from fact_order_items)
    group by 1, 2, 3 order by 1 nulls first, 2 nulls first
"""

STATEMENTS = {
    "bronze_csv_ingest": "select * from b_orders",
    "bronze_contract_ingest": _records(),
    "silver_trim_strings": f"select {_trimmed('customers')} from b_customers",
    "silver_generic_clean": f"select {_trimmed('sellers')} from (select distinct * from b_sellers) "
    f"where {_some_value('sellers')}",
    "schema_check": "select 'order_items' as dataset, 'price' as missing_column, count(*) as blocked_rows "
    "from b_order_items union all select 'sellers', 'seller_city', count(*) from b_sellers",
    **{f"silver_{name}": f"select * from s_{name}" for name in COLUMNS},
    "silver_run_metrics": _metrics(),
    "silver_run_summary": f"""
        select count(*) as datasets_processed, count(*) as successful_jobs, cast(0 as bigint) as failed_jobs,
               cast(sum(rows_before) as bigint) as rows_read, cast(sum(rows_after) as bigint) as rows_written,
               cast(sum(rows_removed) as bigint) as rows_removed
        from ({_metrics()})
    """,
    "silver_run_failures": """
        select 'customers' as dataset, b as rows_before, s as rows_after, b - s as rows_removed, 'SUCCESS' as status
        from (select (select count(*) from b_customers) as b, (select count(*) from s_customers) as s)
        union all select 'order_items', 0, 0, 0, 'SCHEMA FAILED'
        union all select 'geolocation', null, null, null, 'FAILED'
    """,
    "silver_failed_rewrite": "select * from s_customers",
    "silver_merged": _merged(),
    "silver_stream": _silver("orders", "r"),
    "bronze_rejected": _rejected(),
    "run_history": _run_history(),
    "rule_history": _rule_history(),
    **{f"gold_{name}": f"select * from {name}" for name in GOLD},
    "gold_dim_calendar": """
        select date, cast(day(date) as int) as day, cast(month(date) as int) as month,
               monthname(date) as month_name, cast(quarter(date) as int) as quarter,
               cast(year(date) as int) as year, cast(week(date) as int) as week, dayname(date) as weekday
        from (select cast(unnest(generate_series(first, last, interval 1 day)) as date) as date
              from (select min(cast(order_purchase_timestamp as date)) as first,
                           max(cast(order_purchase_timestamp as date)) as last from s_orders))
    """,
    "gold_dim_products_spread": "select * from dim_products",
    "gold_fact_orders_chunked": "select * from fact_orders",
    "gold_fact_order_items_chunked": "select * from fact_order_items",
    "gold_fact_orders_colocated": "select * from fact_orders",
    "kpi_monthly_revenue_colocated": MONTHLY,
    "quality_references": _references(),
    "fact_fanout_audit": """
        select * from (with items as (
            select o.order_id, count(oi.order_id) as items, coalesce(sum(oi.price), 0) as revenue
            from s_orders o left join s_order_items oi on o.order_id = oi.order_id group by o.order_id
        ), paid as (
            select o.order_id, count(p.order_id) as payments
            from s_orders o left join s_payments p on o.order_id = p.order_id group by o.order_id
        ), wide as (
            select order_id, count(*) as fact_rows, coalesce(sum(price), 0) as fact_revenue
            from fact_orders group by order_id
        )
        select order_id, items, payments, fact_rows, cast(revenue as decimal(28,2)) as revenue,
               cast(fact_revenue as decimal(38,2)) as fact_revenue
        from items join paid using (order_id) join wide using (order_id))
    """,
    "quality_report": _report(),
    "quality_duplicate_keys": _duplicates(),
    "quality_summary": "select count(*) filter (status = 'FAIL') as failed_rules, cast(0 as bigint) as unchecked_rules, "
    f"count(*) as total_rules from ({_report()})",
    "quality_record_counts": f"select *, case when silver_rows > 0 and silver_rows <= bronze_rows then 'PASS' "
    f"else 'FAIL' end as status from ({_counts()})",
    # average in whole hundredths, rounded half up in integers
    "kpi_headline": """
        select total_revenue, total_orders, total_customers,
               cast(cast((2 * cast(total_revenue * 100 as hugeint) + total_orders) // (2 * total_orders)
                         as decimal(36,0)) * cast(0.01 as decimal(2,2)) as decimal(38,2)) as average_order_value
        from (
            select cast(coalesce(sum(price), 0) as decimal(38,2)) as total_revenue,
                   count(distinct order_id) as total_orders,
                   (select count(distinct customer_unique_id) from dim_customers) as total_customers
            from fact_order_items
        )
    """,
    "kpi_monthly_revenue": MONTHLY,
    "kpi_revenue_by_state": """
        select c.customer_state, cast(coalesce(sum(f.price), 0) as decimal(38,2)) as revenue
        from fact_order_items f left join dim_customers c on f.customer_id = c.customer_id group by 1
    """,
    "kpi_top_categories": """
        select coalesce(p.product_category_name_english, p.product_category_name) as category,
               cast(sum(f.price) as decimal(38,2)) as revenue
        from fact_order_items f left join dim_products p on f.product_id = p.product_id
        where f.price is not null
        group by 1 order by revenue desc, category asc nulls first limit 10
    """,
    "kpi_top_cities": """
        select s.seller_city, cast(sum(f.price) as decimal(38,2)) as revenue
        from fact_order_items f left join dim_sellers s on f.seller_id = s.seller_id
        where f.price is not null
        group by 1 order by revenue desc, seller_city asc nulls first limit 10
    """,
    "quality_report_written": _report(),
    "quality_failure_messages": "select dataset || ' - ' || rule || ': ' || failed_rows as message "
    f"from ({_report()}) where status = 'FAIL'",
}

STATEMENTS |= {
    f"gold_sql_{figure}": STATEMENTS[f"kpi_{figure}"]
    for figure in ("headline", "monthly_revenue", "revenue_by_state", "top_categories", "top_cities")
}


def statements() -> dict[str, str]:
    return {name: _with(text) for name, text in STATEMENTS.items()}
