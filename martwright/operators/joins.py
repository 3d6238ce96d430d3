"""Left joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from martwright.functions.columns import named, number
from martwright.operators.hitters import HEAVY_TASKS, NONE, Hitters, heavy_hitters, pieces

# A merge join holds the matches of one key on the heap: 100 000 rows are some 30 MB per task.
CHUNK_ROWS = 100_000

# The summary of such keys has at most a quarter of so many: 2.5 billion rows in oversized keys before it is unsure.
_SUMMARY_TASKS = 100_000


def left_join_lookup(rows: DataFrame, table: DataFrame, key: str, spread: str, hitters: Hitters = NONE) -> DataFrame:
    """``rows`` left-joined with ``table``, which holds one row per key.

    Any number of rows may share a key or have none. ``hitters`` are the heavy values of the key as measured
    (``heavy_hitters``): their rows are dealt by the hash of the ``spread`` column over as many tasks as they would
    fill, and only their rows of ``table`` are repeated, once for each. Without any this is the plain join, and other
    keys are joined as in the plain join. The result is the same whatever ``hitters`` says.
    """
    if not hitters.any:
        return rows.join(table, key, "left")
    own = pieces(named(key), hitters)
    salt = F.when(own > 1, F.pmod(F.xxhash64(spread), own).cast("int")).otherwise(0)
    copies = table.withColumn("__salt", F.explode(F.sequence(F.lit(0), own - 1)))
    return rows.withColumn("__salt", salt).join(copies, [key, "__salt"], "left").drop("__salt")


@dataclass(frozen=True)
class Details:
    """Detail rows, at most one per (key, ``sequence``)."""

    rows: DataFrame
    sequence: str


def left_join_details(
    header: DataFrame,
    key: str,
    details: list[Details],
    oversized: Collection[int] | Mapping[int, Collection | None] = (),
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``header`` left-joined with each detail table on ``key``, one after the other.

    ``header`` holds one row per key. All joins use the same key, so every input is shuffled once
    and nothing is shuffled between the joins. Two detail tables multiply: a key with *m* and *n*
    rows yields *m x n*.

    Adaptive skew handling cannot split the right side of a left join, and one key may hold a large
    share of the detail rows. ``oversized`` names the detail tables, by their place, in which that
    may be so (``find_oversized`` looks for them): their rows are cut into chunks of ``chunk_rows``
    sequence numbers; the header row is repeated per chunk and the chunk number joins the key. Where
    it is a mapping to the keys that hold so many rows, only these are cut. The result is the same
    either way, and no job runs here.
    """
    cut = sorted(oversized)
    only = {i: oversized[i] for i in cut if oversized[i] is not None} if isinstance(oversized, Mapping) else {}

    def number_of(i: int) -> Column:
        chunks = _chunk_number(details[i].sequence, chunk_rows)
        return F.when(named(key).isin(list(only[i])), chunks).otherwise(0).cast("bigint") if i in only else chunks

    if not cut:
        return reduce(lambda left, part: left.join(part.rows, key, "left"), details, header)

    chunk, chunks = {i: f"__chunk{i}" for i in cut}, {i: f"__chunks{i}" for i in cut}
    further = {
        i: _beyond_first(details[i], chunk_rows)
        .select(key, number_of(i).alias(chunk[i]))
        .where(named(key).isNotNull() & (F.col(chunk[i]) != 0))
        .groupBy(key)
        .agg(F.collect_set(chunk[i]).alias(chunks[i]))
        for i in cut
    }

    def in_every_chunk(rows: DataFrame, i: int) -> DataFrame:
        """Each row once for the first chunk and for every further one that its key has, whose numbers reach it in one row."""
        none = F.array().cast("array<bigint>")
        numbers = F.concat(F.array(F.lit(0).cast("bigint")), F.coalesce(chunks[i], none))
        return rows.join(further[i], key, "left").withColumn(chunk[i], F.explode(numbers))

    joined = header
    for i in cut:
        several = F.col(chunks[i]).isNotNull().alias(f"__several{i}")
        joined = in_every_chunk(joined, i).select("*", several).drop(chunks[i])

    for i, part in enumerate(details):
        rows = part.rows.withColumn(f"__found{i}", F.lit(True))
        if i in chunk:
            rows = rows.withColumn(chunk[i], number_of(i))
        for j in cut:
            if j != i:
                rows = in_every_chunk(rows, j).drop(chunks[j])
        joined = joined.join(rows, [key, *chunk.values()], "left")

    # A key with several chunks may have none of its rows in the first one: that is not a header
    # without details, so the unmatched row goes.
    for i in cut:
        joined = joined.where(~F.col(f"__several{i}") | F.col(f"__found{i}"))
    helpers = [c for c in joined.columns if c.startswith(("__chunk", "__several", "__found"))]
    return joined.drop(*helpers)


def find_oversized(details: list[Details], key: str, chunk_rows: int = CHUNK_ROWS) -> list[int]:
    """Places of the detail tables in which some key holds more rows than one task should join; runs jobs."""
    return [i for i, part in enumerate(details) if _oversized(part, key, chunk_rows)]


def oversized_keys(details: list[Details], key: str, chunk_rows: int = CHUNK_ROWS) -> dict[int, list | None]:
    """The places of ``find_oversized``, each with the keys to cut, for ``left_join_details``; runs jobs.

    The keys are the heavy hitters of the rows beyond the first chunk, if the summary is sure to hold every key with more
    than ``chunk_rows`` rows there; a key that is not cut then has a few chunks' rows at most. None, where there are too
    many rows for that, stands for all keys with numbers beyond the first chunk.
    """
    found: dict[int, list | None] = {}
    for i, part in enumerate(details):
        if not _oversized(part, key, chunk_rows):
            continue
        found[i] = None
        beyond = _beyond_first(part, chunk_rows).where(named(key).isNotNull()).count()
        if beyond * HEAVY_TASKS <= chunk_rows * _SUMMARY_TASKS:
            hitters = heavy_hitters(_beyond_first(part, chunk_rows), key, _SUMMARY_TASKS)
            if hitters.rows * HEAVY_TASKS <= chunk_rows * _SUMMARY_TASKS:  # these include rows without a key
                found[i] = hitters.values
    return found


def _oversized(part: Details, key: str, chunk_rows: int) -> bool:
    """Whether some key holds more detail rows than one task should join.

    Sequence numbers are unique within a key, so where all of them lie in the first chunk no key
    can exceed it. The test for one beyond it is a range filter on a plain column: on Parquet it
    reads footers and skips the row groups. Only if it fires are the rows per key counted, since
    numbers may be high without being many; the first key found with too many ends that.
    """
    if _beyond_first(part, chunk_rows).select(part.sequence).isEmpty():
        return False
    per_key = part.rows.where(named(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return bool(per_key.where(F.col("rows") > chunk_rows).select("rows").take(1))


def _beyond_first(part: Details, chunk_rows: int) -> DataFrame:
    """The rows that may lie in another chunk than the first; a superset if the numbers are not integers."""
    return part.rows.where(_is_beyond(part, chunk_rows))


def _is_beyond(part: Details, chunk_rows: int) -> Column:
    sequence = number(part.rows, part.sequence)
    return (sequence >= F.lit(chunk_rows)) | (sequence <= F.lit(-chunk_rows))


def _chunk_number(sequence: str, chunk_rows: int) -> Column:
    """What is no number counts as the first chunk."""
    return F.coalesce(F.expr(f"try_cast(`{sequence}` as bigint) div {chunk_rows}"), F.lit(0).cast("bigint"))
