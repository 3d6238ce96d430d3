"""Data-quality rules over one table, counted in as few passes as the plan allows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from martwright.functions.columns import named, number


@dataclass(frozen=True)
class Rule:
    """A labelled rule: a predicate that failing rows meet, or a key that must not repeat.

    A predicate that is NULL for a row does not count as a failure. ``columns`` are those it reads.
    """

    label: str
    columns: tuple[str, ...]
    fails: Callable[[DataFrame], Column] | None = None

    @property
    def unique(self) -> tuple[str, ...]:
        """The key that must not repeat, empty for a predicate."""
        return () if self.fails else self.columns

    def applies_to(self, df: DataFrame) -> bool:
        return set(self.columns) <= set(df.columns)


# The labels of the rules.
def no_null(column: str) -> Rule:
    return Rule(f"Null check: {column}", (column,), lambda df: named(column).isNull())


def no_negative(column: str) -> Rule:
    return Rule(f"Negative value check: {column}", (column,), lambda df: number(df, column) < F.lit(0))


def no_duplicates(*columns: str) -> Rule:
    return Rule(f"Duplicate check: {list(columns)}", columns)


def one_of(label: str, column: str, allowed: Sequence[str]) -> Rule:
    return Rule(label, (column,), lambda df: ~named(column).isin(*allowed))


def in_range(label: str, column: str, low: int, high: int) -> Rule:
    return Rule(label, (column,), lambda df: (number(df, column) < F.lit(low)) | (number(df, column) > F.lit(high)))


def count_failures(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row (rule, failed_rows) per rule.

    All predicates share one aggregate that shuffles a single row per task. A duplicate rule counts
    the keys that occur more than once, NULL keys included; it reads only the key columns and sums
    on the map side before it shuffles them. Carrying the predicate counters through that shuffle
    instead would save the second, narrow scan, but was measured to be slower.
    """
    parts = [
        duplicate_keys(df, rule.unique).withColumnRenamed("duplicates", rule.label) for rule in rules if rule.unique
    ]
    row_rules = [rule for rule in rules if rule.fails]
    if row_rules:
        parts.append(df.agg(*[F.count_if(rule.fails(df)).alias(rule.label) for rule in row_rules]))
    return reduce(DataFrame.unionByName, [_as_rows(part) for part in parts])


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many keys occur more than once: groups, not surplus rows."""
    groups = df.groupBy(*[named(column) for column in columns]).agg(F.count(F.lit(1)).alias("__rows"))
    return groups.agg(F.count_if(F.col("__rows") > 1).alias("duplicates"))


def _as_rows(counts: DataFrame) -> DataFrame:
    return counts.unpivot([], [named(label) for label in counts.columns], "rule", "failed_rows")
