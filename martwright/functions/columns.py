"""Column helpers: quoting, trimming, tolerant numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def named(name: str) -> Column:
    """The column with exactly this name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_plain_string(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.StringType) and data_type.simpleString() == "string"


def trimmed(df: DataFrame) -> list[Column]:
    """Every column of ``df``, the string ones without leading and trailing blanks.

    Only U+0020 is cut: tabs and newlines stay, and a blank-only text becomes the empty string
    rather than NULL.
    """
    return [
        F.trim(named(field.name)).alias(field.name) if is_plain_string(field.dataType) else named(field.name)
        for field in df.schema.fields
    ]


def number(df: DataFrame, name: str) -> Column:
    """The column as something comparable with a number.

    A numeric column is returned as it is, so a comparison stays pushable to the scan. Anything else
    goes through ``try_cast``: a malformed text becomes NULL instead of failing the job.
    """
    if isinstance(df.schema[name].dataType, T.NumericType):
        return named(name)
    return named(name).try_cast("double")


def present(df: DataFrame, name: str) -> Column:
    """Neither NULL nor NaN, as ``na.drop`` sees it, in a form the Parquet reader can use."""
    there = named(name).isNotNull()
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return there & ~F.isnan(named(name))
    return there


def money(name: str) -> Column:
    """An amount as ``decimal(18,2)``: cast before summing, so that sums are exact."""
    return named(name).try_cast("decimal(18,2)")
