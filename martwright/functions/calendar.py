"""Attributes of a calendar date."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def purchase_date(timestamp: str = "order_purchase_timestamp") -> Column:
    return F.to_date(F.col(timestamp)).alias("date")


def purchase_month(year: str, month: str, timestamp: str = "order_purchase_timestamp") -> list[Column]:
    return [F.year(timestamp).alias(year), F.month(timestamp).alias(month)]


def date_attributes(date: str = "date") -> list[Column]:
    """Day, month, month name, quarter, calendar year, ISO week and weekday name of ``date``."""
    day = F.col(date)
    return [
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        F.weekofyear(day).alias("week"),
        F.date_format(day, "EEEE").alias("weekday"),
    ]
