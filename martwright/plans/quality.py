"""The data-quality report over the bronze tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martwright.functions.columns import named, present
from martwright.operators.rules import (
    Rule,
    count_failures,
    duplicate_keys,
    in_range,
    no_duplicates,
    no_negative,
    no_null,
    one_of,
)

# The order states that are allowed.
ORDER_STATUSES = (
    "approved",
    "created",
    "delivered",
    "invoiced",
    "processing",
    "shipped",
    "canceled",
    "unavailable",
)

# The rules per table, in report order.
SUITE: dict[str, tuple[Rule, ...]] = {
    "orders": (
        no_duplicates("order_id"),
        no_null("order_id"),
        no_null("customer_id"),
        no_null("order_purchase_timestamp"),
        one_of("Invalid order status", "order_status", ORDER_STATUSES),
    ),
    "customers": (
        no_duplicates("customer_id"),
        no_null("customer_id"),
        no_null("customer_unique_id"),
    ),
    "order_items": (
        no_duplicates("order_id", "order_item_id"),
        no_null("order_id"),
        no_null("product_id"),
        no_null("seller_id"),
        no_negative("price"),
        no_negative("freight_value"),
    ),
    "payments": (
        no_null("order_id"),
        no_null("payment_type"),
        no_negative("payment_value"),
        no_negative("payment_installments"),
    ),
    "reviews": (
        no_null("review_id"),
        no_null("order_id"),
        in_range("Invalid review score", "review_score", 1, 5),
    ),
    "products": (
        no_duplicates("product_id"),
        no_null("product_id"),
        no_negative("product_weight_g"),
    ),
    "sellers": (
        no_duplicates("seller_id"),
        no_null("seller_id"),
    ),
}


@dataclass(frozen=True)
class Reference:
    """Rows of ``child`` whose ``column`` is set should find it in the column ``target`` of ``parent``."""

    child: str
    column: str
    parent: str
    target: str

    @property
    def label(self) -> str:
        return f"Reference check: {self.column} in {self.parent}"


# The relations between the tables.
REFERENCES = (
    Reference("orders", "customer_id", "customers", "customer_id"),
    Reference("order_items", "order_id", "orders", "order_id"),
    Reference("order_items", "product_id", "products", "product_id"),
    Reference("order_items", "seller_id", "sellers", "seller_id"),
    Reference("payments", "order_id", "orders", "order_id"),
    Reference("reviews", "order_id", "orders", "order_id"),
    Reference("products", "product_category_name", "categories", "product_category_name"),
)

PASS, FAIL, NOT_CHECKED = "PASS", "FAIL", "NOT CHECKED"


def report(
    tables: Mapping[str, DataFrame | None], suite: Mapping[str, tuple[Rule, ...]] = SUITE
) -> DataFrame:
    """One row per rule (dataset, failed_rows, rule, status), all tables in one action.

    A rule whose table is not there, or whose columns its table lacks, is reported as not checked,
    without a number of rows; the others are checked all the same.
    """
    parts, unchecked = [], []
    for name, rules in suite.items():
        table = tables.get(name)
        able = [rule for rule in rules if table is not None and rule.applies_to(table)]
        unchecked += [(name, rule.label) for rule in rules if rule not in able]
        if able:
            counted = count_failures(table, able)
            parts.append(counted.select(F.lit(name).alias("dataset"), "failed_rows", "rule"))
    if unchecked:
        rows = SparkSession.active().createDataFrame(unchecked, "dataset string, rule string")
        parts.append(rows.select("dataset", F.lit(None).cast("bigint").alias("failed_rows"), "rule"))
    return stack(parts).withColumn("status", _status())


def reference_report(
    tables: Mapping[str, DataFrame | None], references: Iterable[Reference] = REFERENCES
) -> DataFrame:
    """One row per relation: orphaned rows and keys, in the columns of ``report`` with ``failed_keys``.

    A row without a key is no orphan; the null rules count it. Child rows are summed per key before they meet the
    parent, so a key with very many rows reaches the join as one. A relation whose table or column is not there is not
    checked.
    """
    parts, unchecked = [], []
    for reference in references:
        child, parent = tables.get(reference.child), tables.get(reference.parent)
        able = child is not None and parent is not None
        if not able or reference.column not in child.columns or reference.target not in parent.columns:
            unchecked.append((reference.child, reference.label))
            continue
        keys = child.where(present(child, reference.column)).groupBy(named(reference.column).alias("key")).agg(
            F.count(F.lit(1)).alias("rows")
        )
        known = parent.select(named(reference.target).alias("key"))
        orphans = keys.join(known, "key", "left_anti").agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("failed_rows"), F.count(F.lit(1)).alias("failed_keys")
        )
        parts.append(
            orphans.select(
                F.lit(reference.child).alias("dataset"), F.lit(reference.label).alias("rule"), "failed_rows", "failed_keys"
            )
        )
    if unchecked:
        rows = SparkSession.active().createDataFrame(unchecked, "dataset string, rule string")
        none = F.lit(None).cast("bigint")
        parts.append(rows.select("dataset", "rule", none.alias("failed_rows"), none.alias("failed_keys")))
    return stack(parts).withColumn("status", _status())


def _status() -> Column:
    failed = F.col("failed_rows")
    return F.when(failed.isNull(), NOT_CHECKED).when(failed == 0, PASS).otherwise(FAIL)


def duplicate_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per unique key of the suite: how many of its values repeat."""
    return stack(
        duplicate_keys(tables[name], rule.unique).select(
            F.lit(name).alias("dataset"),
            F.lit(str(list(rule.unique))).alias("key"),
            F.col("duplicates").alias("duplicate_groups"),
        )
        for name, rules in SUITE.items()
        for rule in rules
        if rule.unique
    )


def summary(report_rows: DataFrame) -> DataFrame:
    """Failed, unchecked and total rules; nothing is raised, the caller decides."""
    return report_rows.agg(
        F.count_if(F.col("status") == FAIL).alias("failed_rules"),
        F.count_if(F.col("status") == NOT_CHECKED).alias("unchecked_rules"),
        F.count(F.lit(1)).alias("total_rules"),
    )


def failure_messages(report_rows: DataFrame) -> DataFrame:
    """One line of text per rule that fails or could not be checked."""
    found = F.coalesce(F.col("failed_rows").cast("string"), F.lower("status"))
    return report_rows.where(F.col("status") != PASS).select(
        F.concat("dataset", F.lit(" - "), "rule", F.lit(": "), found).alias("message")
    )


def record_counts(bronze: Mapping[str, DataFrame | None], silver: Mapping[str, DataFrame | None]) -> DataFrame:
    """Rows per dataset before and after cleaning; PASS if some are left and none were added.

    A table that is not there has no count, and its dataset is not checked. The tables should be
    stored ones: their rows are then counted from file footers.
    """
    sides = {"bronze_rows": bronze, "silver_rows": silver}
    counts = []
    for name in bronze:
        for column, tables in sides.items():
            if tables.get(name) is not None:
                rows = tables[name].agg(F.count(F.lit(1)).alias("rows"))
                counts.append(rows.select(F.lit(name).alias("dataset"), F.lit(column).alias("side"), "rows"))
    listed = SparkSession.active().createDataFrame([(name,) for name in bronze], "dataset string")
    counts.append(listed.select("dataset", F.lit("").alias("side"), F.lit(None).cast("bigint").alias("rows")))
    counted = stack(counts).groupBy("dataset").agg(
        *[F.max(F.when(F.col("side") == column, F.col("rows"))).alias(column) for column in sides]
    )
    kept = (F.col("silver_rows") > 0) & (F.col("silver_rows") <= F.col("bronze_rows"))
    unknown = F.col("silver_rows").isNull() | F.col("bronze_rows").isNull()
    return counted.select(
        "dataset", "bronze_rows", "silver_rows", F.when(unknown, NOT_CHECKED).when(kept, PASS).otherwise(FAIL).alias("status")
    )


def stack(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
