"""Packed exchange: many small entries from many tasks to many targets, in rows that stay large.

A row is for one target and has arrays: the entries, the numbers of the sources they come from (as runs), and what goes
along with each. A task with entries for very many targets would send each of them a row of a few entries, mostly
overhead. So beyond ``MOST_TARGETS`` the entries go over a stop: a first row is for a range of targets and names the
target of each entry (as runs); the task that receives the rows of a range sorts some millions of entries at a time by
target and sends each its own. A task then sends ``MOST_TARGETS`` rows for a chunk at most, whatever the number of targets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martwright.llm.ship import lean

#: Targets that a task sends rows of their own to, and ranges of targets beyond that.
MOST_TARGETS = 4096
#: Entries that a stop sorts at a time.
STOP_ENTRIES = 4_000_000

_BINARY = ("targets", "target_counts", "sources", "source_counts", "entries", "ids", "several")
SCHEMA = pa.schema([pa.field("target", pa.int32()), *(pa.field(name, pa.binary()) for name in _BINARY)])
DDL = "target int, " + ", ".join(f"{name} binary" for name in _BINARY)


def runs(values: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin, and the end."""
    if not len(values):
        return np.zeros(1, np.int64)
    return np.concatenate(([0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]))


def _in_runs(values: np.ndarray) -> tuple[bytes, bytes]:
    ends = runs(values)
    return values[ends[:-1]].astype("<u4").tobytes(), np.diff(ends).astype("<u4").tobytes()


def _from_runs(values: bytes, counts: bytes) -> np.ndarray:
    return np.repeat(np.frombuffer(values, "<u4"), np.frombuffer(counts, "<u4"))


@dataclass(frozen=True)
class Way:
    """Targets have numbers below ``span``; entries are of the type ``kind`` and go over a stop if there are ``ranges``."""

    span: int
    kind: str
    ranges: int = 0

    @classmethod
    def to(cls, targets: int, span: int, kind: str) -> Way:
        """The way to so many targets."""
        return cls(span, kind, MOST_TARGETS if targets > MOST_TARGETS else 0)

    @property
    def width(self) -> int:
        return -(-self.span // self.ranges) if self.ranges else 0

    def rows(self, target: np.ndarray, source: np.ndarray | int, entries: np.ndarray, **more: np.ndarray) -> list[dict]:
        """What a task sends: entries with their targets, sources and what goes along (ids as longs, several as booleans)."""
        return _packed(target, source, entries, self.width, more)

    def arrived(self, sent: DataFrame) -> DataFrame:
        """The rows of each target, after the stop if there is one; ``sent`` has the rows of all tasks."""
        if not self.ranges:
            return sent
        salts = max(1, int(sent.sparkSession.conf.get("spark.sql.shuffle.partitions")) // self.ranges)
        salted = sent.withColumn("salt", F.pmod(F.xxhash64("sources", "source_counts"), F.lit(salts)))
        ranged = salted.repartition("target", "salt").sortWithinPartitions("target").drop("salt")
        return ranged.mapInArrow(lean(self._stop), DDL)

    def _stop(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[dict] = []
        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                if waiting and (row["target"] != waiting[-1]["target"] or size >= STOP_ENTRIES):
                    yield self._sorted(waiting)
                    waiting, size = [], 0
                waiting.append(row)
                size += len(row["entries"]) // np.dtype(self.kind).itemsize
        if waiting:
            yield self._sorted(waiting)

    def _sorted(self, rows: list[dict]) -> pa.RecordBatch:
        source, entries, more = self._joined(rows)
        target = np.concatenate([_from_runs(row["targets"], row["target_counts"]) for row in rows])
        return pa.RecordBatch.from_pylist(_packed(target, source, entries, 0, more), schema=SCHEMA)

    def _joined(self, rows: list[dict]) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
        source = np.concatenate([_from_runs(row["sources"], row["source_counts"]) for row in rows])
        entries = np.concatenate([np.frombuffer(row["entries"], self.kind) for row in rows])
        kinds = {"ids": "<i8", "several": "?"}
        more = {
            name: np.concatenate([np.frombuffer(row[name], kind) for row in rows])
            for name, kind in kinds.items()
            if rows[0][name] is not None
        }
        return source, entries, more

    def unpacked(self, table: pa.Table) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
        """Sources, entries and what goes along, of all rows of a target."""
        if not table.num_rows:
            return np.zeros(0, "<u4"), np.zeros(0, self.kind), {}
        return self._joined(table.select(_BINARY).to_pylist())


def _packed(
    target: np.ndarray, source: np.ndarray | int, entries: np.ndarray, width: int, more: dict[str, np.ndarray]
) -> list[dict]:
    """A row for each target, or for each ``width`` of them."""
    source = np.broadcast_to(np.asarray(source, "<u4"), len(target))
    order = np.lexsort((source, target))
    target, source, entries = target[order], source[order], entries[order]
    more = {name: x[order] for name, x in more.items()}
    ends = runs(target // width if width else target)
    rows = []
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
        row: dict = dict.fromkeys(_BINARY)
        row["target"] = int(target[a]) // (width or 1)
        row["sources"], row["source_counts"] = _in_runs(source[a:b])
        if width:
            row["targets"], row["target_counts"] = _in_runs(target[a:b])
        row |= {"entries": entries[a:b].tobytes(), **{name: x[a:b].tobytes() for name, x in more.items()}}
        rows.append(row)
    return rows
