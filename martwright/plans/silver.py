"""Bronze to silver: schema check, cleaning and the per-dataset rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from martwright.functions.columns import number, present
from martwright.operators.clean import smallest_per_key, trim_strings
from martwright.plans.datasets import DATASETS, Dataset


def silver(dataset: Dataset | str, bronze: DataFrame) -> DataFrame:
    """The cleaned rows of one dataset; one shuffle, on the dataset's key.

    No whole-row distinct precedes the keyed deduplication: exact copies share a key, and the
    smallest of them is the same row with or without them. Not-null rules on key columns are
    written before the deduplication, on the untrimmed column, where the Parquet reader can use
    them and where they keep a NULL key from being shuffled; trimming never makes or removes a
    NULL. All other rules stay behind it, since a survivor that fails a rule takes its key along.
    """
    spec = DATASETS[dataset] if isinstance(dataset, str) else dataset
    return passing(spec, smallest_per_key(candidates(spec, bronze), spec.key or bronze.columns))


def candidates(spec: Dataset, bronze: DataFrame) -> DataFrame:
    """The rows of which the smallest per key is looked for, trimmed."""
    if not spec.key:
        return trim_strings(bronze.na.drop(how="any"))
    key_rules = _key_rules(spec)
    if key_rules:
        rows = bronze.where(_all_of([present(bronze, name) for name in key_rules]))
    else:
        rows = bronze.na.drop(how="all")
    rows = trim_strings(rows)
    if spec.first_between:
        column, low, high = spec.first_between
        rows = rows.where(number(rows, column).between(low, high))
    return rows


def passing(spec: Dataset, rows: DataFrame) -> DataFrame:
    """Those of the smallest rows that meet the rules which come after the deduplication."""
    key_rules = _key_rules(spec)
    later = (
        [present(rows, name) for name in spec.not_null if name not in key_rules]
        + [number(rows, name) > F.lit(0) for name in spec.positive]
        + [number(rows, name) >= F.lit(0) for name in spec.non_negative]
    )
    return rows.where(_all_of(later)) if later else rows


def _key_rules(spec: Dataset) -> list[str]:
    return [name for name in spec.not_null if name in spec.key]


def _all_of(rules: list[Column]) -> Column:
    return reduce(Column.__and__, rules)


def missing_columns(dataset: Dataset | str, bronze: DataFrame) -> list[str]:
    """Contract columns the table lacks; a metadata check, no job."""
    spec = DATASETS[dataset] if isinstance(dataset, str) else dataset
    return spec.missing(bronze.columns)
