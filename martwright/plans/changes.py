"""Batches of changes merged into silver by key, rewriting only the parts of the table that they touch.

The state of a dataset is the smallest row of every key, before the rules that come after the deduplication: a later
batch may bring a smaller row than the one that passes, or than the one that fails. It is a table in parts, dealt by a
hash of the key. A batch meets rows of its parts only. A part may lie in several folders, each with one row per key: a
batch adds a folder, and takes up those last ones that are no larger than what it brings, so that each folder is larger
than all later ones together. A part of *n* rows thus has some log2(*n*) folders at most, and in any number of batches a row
is written again as many times, instead of once for every batch; readers take the smallest of a key's rows. All is
replaced in one commit. Since a smallest row of smallest rows is the smallest, any split of the input into batches, in
any order and with any batch applied twice, gives the state of the whole input at once; silver is the state's rows that
pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martwright.functions.columns import named
from martwright.operators.clean import smallest_per_key
from martwright.plans.datasets import DATASETS, Dataset
from martwright.plans.silver import candidates, missing_columns, passing
from martwright.session import shuffle_partitions_for
from martwright.sources import versions
from martwright.sources.layout import Layout

#: Parts for each task's worth of the first batch: a small batch then touches a small share of a table.
PARTS_PER_TASK = 4
MOST_PARTS = 20_000

#: Folders of so few rows are always taken up.
FEW_ROWS = 10_000

#: Times that a batch is merged again because another writer was first.
ATTEMPTS = 5


class MissingColumns(ValueError):
    """A batch lacks contract columns; nothing was changed."""


def state_path(layout: Layout, name: str) -> str:
    return layout.table("silver-state", name)


def apply_batch(
    spark: SparkSession, layout: Layout, name: str, batch: DataFrame, parts: int | None = None, batch_id: str = ""
) -> versions.Version:
    """Merge bronze rows of the dataset into its state and return the new version.

    ``parts`` is the number of parts of a state that is not there yet; otherwise its own number holds. A batch whose
    ``batch_id`` is that of the last commit was merged already and is passed over.
    """
    spec, path = DATASETS[name], state_path(layout, name)
    missing = missing_columns(spec, batch)
    if missing:
        raise MissingColumns(f"{name} lacks {', '.join(missing)}")
    for attempt in range(ATTEMPTS):
        base = versions.current(spark, path)
        if base and batch_id and base.made_from.get("batch") == batch_id:
            return base
        of = base.of if base else parts or _parts_for(batch)
        try:
            return _merged(spark, spec, batch, path, base, of, batch_id)
        except versions.Conflict:
            if attempt + 1 == ATTEMPTS:
                raise
    raise AssertionError("unreachable")


def _merged(
    spark: SparkSession, spec: Dataset, batch: DataFrame, path: str, base: versions.Version | None, of: int, batch_id: str
) -> versions.Version:
    key = list(spec.key or batch.columns)
    new = candidates(spec, batch)
    if base:
        columns = spark.createDataFrame([], base.ddl).columns
        if set(columns) != set(new.columns):
            raise ValueError(f"{path} has the columns {columns}, the batch {new.columns}")
        new = new.select(*[named(column) for column in columns])
    if not base:
        return _replaced(new, path, key, of, None, (), {}, batch_id)
    new = new.persist()  # counted first, merged then
    try:
        brought = {str(part): rows for part, rows in new.groupBy(_part(key, of)).count().collect()}
        staying = {part: _staying([at[1] for at in base.runs(part)], rows) for part, rows in brought.items()}
        old = versions.part_rows(spark, path, base, brought, staying)
        return _replaced(old.unionByName(new), path, key, of, base, brought, staying, batch_id)
    finally:
        new.unpersist()


def _replaced(
    rows: DataFrame,
    path: str,
    key: list[str],
    of: int,
    base: versions.Version | None,
    parts: Iterable[str],
    staying: Mapping[str, int],
    batch_id: str,
) -> versions.Version:
    dealt = smallest_per_key(rows, key).withColumn(versions.PART, _part(key, of))
    return versions.replace_parts(dealt, path, parts, of, base, {"batch": batch_id} if batch_id else None, after=staying)


def _staying(folders: list[int], rows: int) -> int:
    """How many of a part's folders stay beside ``rows`` further rows; the others are merged with these."""
    left = len(folders)
    while left and folders[left - 1] <= max(rows, FEW_ROWS):
        left -= 1
        rows += folders[left]
    return left


def _part(key: list[str], of: int) -> Column:
    return F.pmod(F.xxhash64(*[named(name) for name in key]), F.lit(of)).cast("int")


def _parts_for(batch: DataFrame) -> int:
    size = int(batch._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return min(MOST_PARTS, PARTS_PER_TASK * shuffle_partitions_for(size, batch.sparkSession.sparkContext.defaultParallelism))


def current_silver(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """The silver rows of the merged state."""
    spec, path = DATASETS[name], state_path(layout, name)
    version = versions.current(spark, path)
    state = versions.frame(spark, path, version)
    if version and version.later:
        several = smallest_per_key(versions.part_rows(spark, path, version, version.later), spec.key or state.columns)
        state = versions.part_rows(spark, path, version, version.parts.keys() - version.later).unionByName(several)
    return passing(spec, state)
