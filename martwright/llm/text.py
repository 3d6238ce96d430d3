"""Whole texts as numpy arrays: words, word hashes and rolling n-gram hashes of an Arrow column.

The functions work on the bytes of many texts at once, in chunks of bounded size, so that memory does not grow with the
number of rows in an Arrow batch. A null text counts as empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are hashed at a time; a longer text is a chunk of its own.
CHUNK_BYTES = (1 << 20) - 64

_BYTES = np.arange(256)
#: Word bytes of ``[^\x20\x09-\x0D]+``.
NOT_SPACE = ~((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
#: Word bytes of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower-cased.
ALPHANUMERIC = (
    ((_BYTES >= 0x30) & (_BYTES <= 0x39))
    | ((_BYTES >= 0x41) & (_BYTES <= 0x5A))
    | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
    | (_BYTES >= 0x80)
)
#: ASCII letters and everything beyond ASCII.
LETTER = ALPHANUMERIC & ~((_BYTES >= 0x30) & (_BYTES <= 0x39))
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of one odd number and of its inverse modulo 2**64, kept for chunks of the usual size."""

    KEPT = 1 << 21

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.kept = (np.ones(1, np.uint64), np.ones(1, np.uint64))

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        up, down = self.kept
        while len(up) < n:
            size = len(up)
            up = np.concatenate([up, up * np.uint64(pow(self.base, size, 2**64))])
            down = np.concatenate([down, down * np.uint64(pow(self.inverse, size, 2**64))])
            if len(up) <= self.KEPT:
                self.kept = up, down
        return up, down


_powers = _Powers(0x5851F42D4C957F2D)


class Hasher:
    """A family of polynomial hashes modulo 2**64, whose values of the bytes are chosen by ``seed``.

    Unequal texts with equal hashes can be made, so a hash only finds candidates; ``codes`` and ``digests`` tell
    whether they are equal.

    ``spans`` hashes byte ranges and ``windows`` hashes runs of word hashes, both from one running sum: the difference of
    two sums times the inverse power of the first position does not depend on where the range stands.
    """

    def __init__(self, seed: int, fold_case: bool = False) -> None:
        rng = np.random.default_rng(seed)
        self.byte_values = rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        if fold_case:
            self.byte_values = self.byte_values[LOWER]

    def _ranges(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        up, down = _powers(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * up[: len(values)], out=sums[1:])
        return (sums[ends] - sums[starts]) * down[starts]

    def spans(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        lengths = (ends - starts).astype(np.uint64)
        return mix(self._ranges(self.byte_values[data], starts, ends) + lengths * np.uint64(0x9E3779B97F4A7C15))

    def windows(self, hashes: np.ndarray, size: int) -> np.ndarray:
        """Hash of each run of ``size`` hashes, as many as there are whole runs."""
        starts = np.arange(max(0, len(hashes) - size + 1))
        return mix(self._ranges(hashes, starts, starts + size))


def ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.LargeBinaryArray:
    """The bytes of ranges, which ascend and do not overlap, as an array."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    change = np.zeros(len(data) + 1, np.int8)
    some = ends > starts
    np.add.at(change, starts[some], 1)
    np.subtract.at(change, ends[some], 1)
    inside = data[np.cumsum(change[:-1], dtype=np.int8).astype(bool)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(inside)])


def codes(values: pa.Array) -> np.ndarray:
    """A number for each value from 0 on, the same for values with the same bytes and for no others."""
    return values.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def run_codes(numbers: np.ndarray, size: int) -> np.ndarray:
    """A number for each run of ``size`` codes, the same for equal runs and for no others."""
    count = max(0, len(numbers) - size + 1)
    found, most = numbers[:count], int(numbers.max(initial=0)) + 1
    room = int(found.max(initial=0)) + 1
    for step in range(1, size):
        if room * most >= 1 << 62:
            found = np.unique(found, return_inverse=True)[1]
            room = count
        found = found * most + numbers[step : step + count]
        room *= most
    return found


@dataclass
class Words:
    """The words of some consecutive rows: byte ranges in ``data``, and where each row's words begin in them."""

    first_row: int
    data: np.ndarray
    row_bytes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    row_words: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.row_bytes) - 1

    def texts(self) -> pa.LargeBinaryArray:
        """The words themselves."""
        return ranges(self.data, self.starts, self.ends)

    def row_of_words(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.row_words))

    def window_starts(self, size: int) -> np.ndarray:
        """True at the words where a run of ``size`` words of one row begins."""
        left = np.repeat(self.row_words[1:], np.diff(self.row_words)) - np.arange(len(self.starts))
        return left >= size


def as_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string (UTF-8) or binary column and the offsets of its rows; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks else pa.array([], pa.string())
    if isinstance(column, pa.ChunkedArray):  # combine_chunks may still return several
        column = pa.concat_arrays(column.chunks)
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), ends


def row_chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes, or one row."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, min(end, rows)
        row = min(end, rows)


def digests(words: Words, start: np.ndarray, size: int, digest_bytes: int) -> np.ndarray:
    """Digests of the runs of ``size`` words from ``start`` on, a row of bytes each.

    Digested are the words joined by one space, so equal runs have equal digests whatever stands between the words
    (BLAKE2b).
    """
    joined, begins = normal_form(words)
    ends = np.append(begins[1:], len(joined)) - 1
    view, digest = memoryview(joined), hashlib.blake2b
    parts = [
        digest(view[a:b], digest_size=digest_bytes).digest()
        for a, b in zip(begins[start].tolist(), ends[start + size - 1].tolist(), strict=True)
    ]
    return np.frombuffer(b"".join(parts), np.uint8).reshape(-1, digest_bytes)


def normal_form(words: Words) -> tuple[bytes, np.ndarray]:
    """All words, each with one space behind it, and where they begin there."""
    lengths = words.ends - words.starts + 1
    begins = np.cumsum(lengths) - lengths
    source = np.repeat(words.starts - begins, lengths) + np.arange(int(lengths.sum()))
    joined = words.data[np.minimum(source, max(0, len(words.data) - 1))] if len(source) else np.zeros(0, np.uint8)
    joined[begins + lengths - 1] = 32
    return joined.tobytes(), begins


def split_words(data: np.ndarray, row_bytes: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and where each row's words begin; no word spans two rows."""
    inside = word_byte[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    borders = row_bytes[(row_bytes > 0) & (row_bytes < len(data))]
    first[borders] = inside[borders]
    last[borders - 1] = inside[borders - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, row_bytes)


def words_of(column: pa.Array | pa.ChunkedArray, word_byte: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[Words]:
    """The words of every row, chunk by chunk; every row is in exactly one chunk."""
    data, offsets = as_bytes(column)
    for a, b in row_chunks(offsets, limit):
        part = data[offsets[a] : offsets[b]]
        row_bytes = offsets[a : b + 1] - offsets[a]
        starts, ends, row_words = split_words(part, row_bytes, word_byte)
        yield Words(a, part, row_bytes, starts, ends, row_words)
