"""Hashed word n-grams of whole texts, as sparse rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from martwright.llm.text import LETTER, NOT_SPACE, Hasher, mix, row_chunks, as_bytes, split_words

Rows = Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]

#: Distance in words -> constant that tells its n-grams from the others.
_PAIR = {1: 0x1B873593CC9E2D51, 2: 0x38495AB5E6546B64, 3: 0x561CCD1B85EBCA6B}
_SAME = np.uint64(0x2545F4914F6CDD1D)

_lower = Hasher(11, fold_case=True)
_cased = Hasher(12)
#: Every byte that is neither a letter nor space is a token of its own kind.
_SYMBOL = NOT_SPACE & ~LETTER


def _index(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


def _pairs(hashes: np.ndarray, row: np.ndarray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``gap`` apart within a row, and their rows."""
    if len(hashes) <= gap:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    same = row[gap:] == row[:-gap]
    both = mix(hashes[:-gap] * np.uint64(_PAIR[gap] | 1) + hashes[gap:])
    return both[same], row[:-gap][same]


def _wanted(hashes: np.ndarray, row: np.ndarray, bits: int, known: np.ndarray | None) -> np.ndarray:
    """Row and index of each feature in one number, of those that are ``known``."""
    index = _index(hashes, bits)
    if known is not None:
        some = known[index]
        index, row = index[some], row[some]
    return row << bits | index


def present_ngrams(column: pa.Array, bits: int, known: np.ndarray | None = None) -> Rows:
    """Letter words, lower-cased: words, pairs and pairs that skip one or two words; each at most once a row, value 1.

    With ``known``, true at the indexes that are wanted, the others are left out before anything is sorted.

    Symbols and digits are left out, so a word is the same with and without punctuation around it.
    """
    data, offsets = as_bytes(column)
    for a, b in row_chunks(offsets):
        part, borders = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        starts, ends, of_row = split_words(part, borders, LETTER)
        hashes = _lower.spans(part, starts, ends)
        row = np.repeat(np.arange(b - a), np.diff(of_row))
        found = [(hashes, row)] + [_pairs(hashes, row, gap) for gap in (1, 2, 3)]
        once = np.unique(np.concatenate([_wanted(*f, bits, known) for f in found]))
        yield a, b - a, once >> bits, once & ((1 << bits) - 1), np.ones(len(once))


def counted_ngrams(column: pa.Array, bits: int, known: np.ndarray | None = None) -> Rows:
    """Runs of letters and runs of symbols, with their case: tokens and pairs, value count / sqrt(tokens of the row).

    A token equal to the one before it is written as a back-reference, so repetition looks alike whatever the word.
    """
    data, offsets = as_bytes(column)
    for a, b in row_chunks(offsets):
        part, borders = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        runs = [split_words(part, borders, kind) for kind in (LETTER, _SYMBOL)]
        starts, ends = np.concatenate([r[0] for r in runs]), np.concatenate([r[1] for r in runs])
        order = np.argsort(starts, kind="stable")
        starts, ends = starts[order], ends[order]
        row = np.searchsorted(borders, starts, "right") - 1
        hashes = _cased.spans(part, starts, ends)
        again = np.zeros(len(hashes), bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
        hashes[again] = _SAME
        found = [(hashes, row), _pairs(hashes, row, 1)]
        key, count = np.unique(np.concatenate([_wanted(*f, bits, known) for f in found]), return_counts=True)
        of_row = key >> bits
        tokens = np.bincount(row, minlength=b - a)
        yield a, b - a, of_row, key & ((1 << bits) - 1), count / np.sqrt(tokens[of_row])
