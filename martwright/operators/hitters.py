"""Heavy hitters of a join key: which values hold more rows than a task should get, measured in one pass."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from martwright.functions.columns import named

#: A value is heavy if it holds as many rows as so many average tasks.
HEAVY_TASKS = 4

#: Counters of the summary for every value that may be heavy; a count is off by at most one part in
#: 0.75 times the counters. Spark allows a million counters.
_COUNTERS = 8
_MOST_COUNTERS = 1_000_000
_LEAST_COUNTERS = 1024


@dataclass(frozen=True)
class Hitters:
    """Heavy values of a key with their rows, the largest first; ``missing`` is the number of rows without a key."""

    rows: int = 0
    missing: int = 0
    counts: tuple[tuple[Any, int], ...] = ()
    tasks: int = 1

    @property
    def values(self) -> list[Any]:
        return [value for value, _ in self.counts]

    def share(self, count: int) -> int:
        """Tasks over which rows of one value are dealt, so that each gets about an average task's rows; a power of two."""
        return 1 << max(0, -(-count * self.tasks // max(self.rows, 1)) - 1).bit_length()

    @property
    def any(self) -> bool:
        return bool(self.counts) or self.missing_is_heavy

    @property
    def missing_is_heavy(self) -> bool:
        return self.missing * self.tasks > HEAVY_TASKS * self.rows


NONE = Hitters()


def heavy_hitters(rows: DataFrame, key: str, tasks: int) -> Hitters:
    """The values of ``key`` that hold at least ``HEAVY_TASKS`` / ``tasks`` of the rows; runs one job over that column.

    Every task counts its most frequent values in a bounded number of counters, and the counters are merged on the way
    to the one row that reaches the driver (``approx_top_k``). Values above the share are never missed; one a little
    below it may be reported.
    """
    most = max(1, tasks // HEAVY_TASKS) + 1  # one place may be that of the missing key
    counters = min(_MOST_COUNTERS, max(_LEAST_COUNTERS, _COUNTERS * most))
    found = rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(named(key).isNull()).alias("missing"),
        F.call_function("approx_top_k", named(key), F.lit(most), F.lit(counters)).alias("top"),
    ).first()
    counts = [(x["item"], x["count"]) for x in found["top"] or [] if x["item"] is not None]
    heavy = [(value, count) for value, count in counts if count * tasks >= HEAVY_TASKS * found["rows"]]
    return Hitters(found["rows"], found["missing"], tuple(heavy), tasks)


def pieces(key: Column, hitters: Hitters) -> Column:
    """Into how many pieces the rows of a key's value are dealt: 1 for all values that are not heavy."""
    by_pieces: dict[int, list[Any]] = {}
    for value, count in hitters.counts:
        by_pieces.setdefault(hitters.share(count), []).append(value)
    result = F.lit(1)
    for number, values in sorted(by_pieces.items()):
        result = F.when(key.isin(values), number).otherwise(result)
    if hitters.missing_is_heavy:
        result = F.when(key.isNull(), hitters.share(hitters.missing)).otherwise(result)
    return result
