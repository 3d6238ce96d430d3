"""Raw files merged into silver as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from martwright.plans.changes import apply_batch
from martwright.plans.datasets import DATASETS
from martwright.sources.layout import Layout
from martwright.sources.raw_csv import CSV


def arriving(
    spark: SparkSession, layout: Layout, name: str, files_per_batch: int = 1000, columns: Sequence[str] | None = None
) -> DataFrame:
    """The dataset's raw files as a stream, with the types and options of the batch reader.

    ``columns`` is the files' header, all columns of the contract by default: the first file may not be there yet, so it
    cannot be read from it. A file with another header ends the query.
    """
    spec = DATASETS[name]
    ddl = ", ".join(f"`{column}` {spec.types.get(column, 'string')}" for column in columns or spec.types)
    reader = spark.readStream.options(**CSV, multiLine=spec.multiline, enforceSchema=False, maxFilesPerTrigger=files_per_batch)
    return reader.schema(ddl).csv(layout.raw(name))


def start(
    spark: SparkSession,
    layout: Layout,
    name: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    parts: int | None = None,
    columns: Sequence[str] | None = None,
) -> StreamingQuery:
    """Merge the files that are there and not yet merged, in batches, and stop.

    Offsets are kept in ``checkpoint``, so a further start goes on where the last one ended or broke off. A batch that was
    merged but not noted as done comes again under the same number, which the table's commit record has, and merging is
    idempotent besides: no row is lost or doubled. There is no watermark: the table itself is the state that an arriving
    row is compared with, so a row may come as late as it likes.
    """
    rows = arriving(spark, layout, name, files_per_batch, columns)

    def merge(batch: DataFrame, number: int) -> None:
        apply_batch(batch.sparkSession, layout, name, batch, parts, f"{checkpoint} {number}")

    return (
        rows.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .queryName(f"silver-{name}")
        .start()
    )
