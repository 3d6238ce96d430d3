"""Generic cleaning: whole-row distinct, empty rows, trimming, keyed deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from martwright.functions.columns import named, trimmed


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim all string columns in one projection."""
    return df.select(*trimmed(df))


def generic_clean(df: DataFrame) -> DataFrame:
    """Distinct rows, then no all-NULL rows, then trimmed text.

    The order is part of the result: copies that differ only in their padding survive the distinct,
    and a row of blanks is not an all-NULL row.
    """
    return trim_strings(df.distinct().na.drop(how="all"))


def smallest_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the smallest one, comparing the other columns left to right, NULLs first.

    ``dropDuplicates(keys)`` keeps whichever row arrives first, so its result (and the count after
    any later filter) depends on the task order. The first row of a window is the same on every run.
    Spark keeps the first row of a key in each task before it shuffles, so a key that holds a large
    share of all rows costs its reducer one row per map task. NULL keys form a group of their own.
    """
    rest = [column for column in df.columns if column not in set(keys)]
    if not rest:
        return df.distinct()
    smallest_first = Window.partitionBy(*[named(key) for key in keys]).orderBy(
        *[named(column).asc_nulls_first() for column in rest]
    )
    return df.withColumn("__place", F.row_number().over(smallest_first)).where("__place = 1").drop("__place")
