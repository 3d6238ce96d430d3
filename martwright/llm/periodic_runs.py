"""Periodic runs of words, found by internal pattern matching.

A run is a maximal stretch of words with smallest period q that is at least four periods long. For the level with
2**k <= q < 2**(k + 1), the first dyadic block (2**k words from a multiple of 2**k) inside the run occurs again q words
later. So every block asks for its own occurrences in the neighbouring window of starts, 2**k to 2**(k + 1) words on. The
occurrences of all blocks are intervals of one suffix array, and a wavelet tree over it answers by range successor. In
a window no longer than the block, occurrences form a progression: one or two of them are the candidate periods
themselves; three or more have the block's own period p as their difference, and then only the distance between the ends
of the two p-periodic stretches can be a period of the run. Candidates are extended to both sides by comparing blocks of
falling size, hence every run is exact.

The suffix array is made by prefix doubling, whose ranks are kept for the comparisons: 4 bytes a word and level, and no
more levels than the longest repetition in a text has. Texts are handled in chunks of about 1 MB, a longer one by itself.
No text meets another, so there is no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from martwright.llm.ship import lean, shipped
from martwright.llm.text import NOT_SPACE, Words, codes, words_of

#: Least words of a run, and least periods in it.
LEAST_WORDS = 6
LEAST_PERIODS = 4

RUNS = "runs array<struct<start: long, length: long, period: long>>"


class WaveletTree:
    """Values below 2**bits in a sequence, as bit planes: ranks and order statistics of any range, many at a time."""

    def __init__(self, values: np.ndarray) -> None:
        self.size = len(values)
        self.bits = int(self.size).bit_length()
        self.planes: list[tuple[np.ndarray, np.ndarray, int]] = []
        for bit in reversed(range(self.bits)):
            ones = (values >> bit & 1).astype(bool)
            padded = np.zeros((self.size // 64 + 1) * 64, bool)
            padded[: self.size] = ones
            words = np.packbits(padded, bitorder="little").view("<u8")
            before = np.zeros(len(words), np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
            self.planes.append((words, before, self.size - int(ones.sum())))
            values = np.concatenate([values[~ones], values[ones]])

    @staticmethod
    def _ones(plane: tuple[np.ndarray, np.ndarray, int], ends: np.ndarray) -> np.ndarray:
        words, before, _ = plane
        word = ends >> 6
        inside = words[word] & ((np.uint64(1) << (ends & 63).astype(np.uint64)) - np.uint64(1))
        return before[word] + np.bitwise_count(inside)

    def smaller(self, low: np.ndarray, high: np.ndarray, than: np.ndarray) -> np.ndarray:
        """How many values at the places from low to high are smaller than ``than``, which is 2**bits - 1 at most."""
        found = np.zeros(len(low), np.int64)
        for plane, bit in zip(self.planes, reversed(range(self.bits)), strict=True):
            a, b = self._ones(plane, low), self._ones(plane, high)
            right = (than >> bit & 1).astype(bool)
            found += np.where(right, (high - low) - (b - a), 0)
            low, high = np.where(right, plane[2] + a, low - a), np.where(right, plane[2] + b, high - b)
        return found

    def smallest(self, low: np.ndarray, high: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The n-th smallest value (from 0) at the places from low to high."""
        value = np.zeros(len(low), np.int64)
        for plane, bit in zip(self.planes, reversed(range(self.bits)), strict=True):
            a, b = self._ones(plane, low), self._ones(plane, high)
            zeros = (high - low) - (b - a)
            right = nth >= zeros
            value += right.astype(np.int64) << bit
            nth = np.where(right, nth - zeros, nth)
            low, high = np.where(right, plane[2] + a, low - a), np.where(right, plane[2] + b, high - b)
        return value


@dataclass
class Blocks:
    """Blocks of one level that occur often enough, and the suffixes that begin with each: an interval of the array."""

    level: int
    start: np.ndarray
    low: np.ndarray
    high: np.ndarray


class Texts:
    """Words of some texts as numbers: suffix array, ranks of all blocks of 2**k words, and the blocks worth asking."""

    def __init__(self, codes: np.ndarray, row_words: np.ndarray) -> None:
        n = len(codes)
        lengths = np.diff(row_words)
        self.begin = np.repeat(row_words[:-1], lengths)
        self.end = np.repeat(row_words[1:], lengths)
        self.ranks: list[np.ndarray] = []
        self.blocks: list[Blocks] = []
        self.order = np.arange(n)
        rank, size = np.zeros(n, np.int32), np.zeros(n, np.int32)
        # level 0: the word, apart for each text
        slots, members = np.arange(n), np.arange(n)
        key = self.begin * np.int64(int(codes.max(initial=0)) + 1) + codes
        half = 0
        while len(members):
            if half:
                after = members + half
                next_rank = np.where(after < self.end[members], rank[np.minimum(after, n - 1)].astype(np.int64) + 1, 0)
                key = rank[members].astype(np.int64) * (n + 1) + next_rank
            by_key = np.argsort(key, kind="stable")
            members, key = members[by_key], key[by_key]
            self.order[slots] = members
            head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            sizes = np.diff(np.append(head, len(key)))
            rank = rank.copy()
            rank[members] = np.repeat(slots[head], sizes)
            size[slots[head]] = sizes
            self.ranks.append(rank)
            block = half * 2 if half else 1
            self._ask(block, rank, size)
            repeated = np.repeat(sizes > 1, sizes)
            slots, members = slots[repeated], members[repeated]
            half = block
            if half * 2 * LEAST_PERIODS > lengths.max(initial=0):
                break

    def _ask(self, block: int, rank: np.ndarray, size: np.ndarray) -> None:
        """A run's first block occurs at least three times in it, the last time two periods on."""
        start = np.arange(0, len(rank), block)
        low = rank[start].astype(np.int64)
        often = (size[low] >= 3) & (start + 3 * block <= self.end[start])
        start, low = start[often], low[often]
        self.blocks.append(Blocks(block.bit_length() - 1, start, low, low + size[low]))

    def common_right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words from a and from b on, where a < b are places in one text."""
        found, end = np.zeros(len(a), np.int64), self.end[np.minimum(b, len(self.end) - 1)]
        last = len(self.end) - 1
        for level in reversed(range(len(self.ranks))):
            step, rank = 1 << level, self.ranks[level]
            more = np.arange(len(a))
            while len(more):
                x, y = a[more] + found[more], b[more] + found[more]
                more = more[(y + step <= end[more]) & (rank[np.minimum(x, last)] == rank[np.minimum(y, last)])]
                found[more] += step
                if level + 1 < len(self.ranks):
                    break
        return found

    def common_left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words before a and before b."""
        found, begin = np.zeros(len(a), np.int64), self.begin[a]
        for level in reversed(range(len(self.ranks))):
            step, rank = 1 << level, self.ranks[level]
            more = np.arange(len(a))
            while len(more):
                x, y = a[more] - found[more] - step, b[more] - found[more] - step
                more = more[(x >= begin[more]) & (rank[np.maximum(x, 0)] == rank[np.maximum(y, 0)])]
                found[more] += step
                if level + 1 < len(self.ranks):
                    break
        return found

    def candidates(self, tree: WaveletTree, asked: Blocks) -> tuple[np.ndarray, np.ndarray]:
        """Blocks (their starts) and candidate periods, from the progression of occurrences in the neighbouring window."""
        block = 1 << asked.level
        before = tree.smaller(asked.low, asked.high, asked.start + block)
        window_end = np.minimum(asked.start + 2 * block, tree.size)
        count = tree.smaller(asked.low, asked.high, window_end) - before
        some = np.flatnonzero(count)
        start, low, high, before, count = asked.start[some], asked.low[some], asked.high[some], before[some], count[some]
        first = tree.smallest(low, high, before)
        several = np.flatnonzero(count > 1)
        second = tree.smallest(low[several], high[several], before[several] + 1)
        few = count <= 2
        pairs = several[count[several] == 2]
        starts = [start[few], start[pairs]]
        periods = [first[few] - start[few], second[count[several] == 2] - start[pairs]]
        many = count[several] > 2
        if many.any():
            i, o, p = start[several[many]], first[several[many]], second[many] - first[several[many]]
            q = (o + self.common_right(o, o + p)) - (i + self.common_right(i, i + p))
            starts.append(i[q > 0])
            periods.append(q[q > 0])
        i, q = np.concatenate(starts), np.concatenate(periods)
        again, rank = i + 2 * q, self.ranks[asked.level]
        inside = (q >= block) & (q < 2 * block) & (again + block <= self.end[i])
        i, q, again = i[inside], q[inside], again[inside]
        same = (rank[i] == rank[i + q]) & (rank[i] == rank[again])
        i, q = i[same], q[same]
        # neighbouring blocks with the same period lie in the same stretch
        order = np.lexsort((i, q))
        i, q = i[order], q[order]
        new = np.append(True, (q[1:] != q[:-1]) | (i[1:] > i[:-1] + block))[: len(i)]
        return i[new], q[new]

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and smallest period of every run, sorted by start, then period."""
        asked = [blocks for blocks in self.blocks if len(blocks.start)]
        if not asked:
            return (np.zeros(0, np.int64),) * 3
        tree = WaveletTree(self.order)
        found = [self.candidates(tree, blocks) for blocks in asked]
        i, q = (np.concatenate(parts) for parts in zip(*found, strict=True))
        start = i - self.common_left(i, i + q)
        end = i + q + self.common_right(i, i + q)
        long = end - start >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
        start, end, q = start[long], end[long], q[long]
        # a multiple of the smallest period has the same ends
        order = np.lexsort((q, end, start))
        start, end, q = start[order], end[order], q[order]
        new = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))[: len(start)]
        start, end, q = start[new], end[new], q[new]
        order = np.lexsort((q, start))
        return start[order], end[order], q[order]


def _joined(words: Words, column: pa.Array, keep: np.ndarray) -> pa.Array:
    """The kept words of each row, joined by one space."""
    kept = column.filter(pa.array(keep))
    counts = np.concatenate([[0], np.cumsum(keep)])
    rows = pa.LargeListArray.from_arrays(pa.array(counts[words.row_words]), kept)
    return pc.binary_join(rows, pa.scalar(b" ", pa.large_binary())).cast(pa.binary()).cast(pa.string())


def _of_chunk(words: Words) -> tuple[pa.Array, pa.Array]:
    """The runs and the collapsed text of each row."""
    column = words.texts()
    code = codes(column)
    start, end, period = Texts(code, words.row_words).runs()
    row = np.searchsorted(words.row_words, start, "right") - 1
    change = np.zeros(len(code) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, end, -1)
    keep = np.cumsum(change)[:-1] == 0
    fields = [pa.array(start - words.row_words[row]), pa.array(end - start), pa.array(period)]
    offsets = np.searchsorted(row, np.arange(words.rows + 1)).astype(np.int32)
    structs = pa.StructArray.from_arrays(fields, names=["start", "length", "period"])
    return pa.ListArray.from_arrays(pa.array(offsets), structs), _joined(words, column, keep)


def periodic_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, runs, collapsed): one row per row of ``docs`` (doc_id, text); other columns are not read.

    Words are maximal runs of other characters than ASCII white space and are compared byte by byte. ``runs`` has the
    start (a word's number, from 0), length and smallest period of every run, by start, then period; runs may overlap.
    ``collapsed`` is the text without the words that any run contains after its first period, joined by one space. A null,
    empty or blank text has no runs and an empty collapsed text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_of_chunk(words) for words in words_of(batch.column("text"), NOT_SPACE)]
            if found:
                runs, collapsed = (pa.concat_arrays(parts) for parts in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), runs, collapsed], names=["doc_id", "runs", "collapsed"])

    rows = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {RUNS}, collapsed string"
    return shipped(rows).mapInArrow(lean(run), schema)


def longest(runs: str) -> Column:
    """The longest run of the column ``runs``; of equal ones that with the smallest start, then period. Null without runs."""
    best = F.array_max(
        F.transform(
            runs, lambda x: F.struct(x["length"].alias("length"), (-x["start"]).alias("start"), (-x["period"]).alias("period"))
        )
    )
    return F.struct((-best["start"]).alias("start"), best["length"].alias("length"), (-best["period"]).alias("period"))
