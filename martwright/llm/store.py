"""Intermediate results as Parquet in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from martwright.sources.scratch import scratch_dir


def stored(rows: DataFrame) -> DataFrame:
    """``rows`` written and read again: the lineage is cut, and a lost executor costs no earlier work."""
    path = scratch_dir(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
