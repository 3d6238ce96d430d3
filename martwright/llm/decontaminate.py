"""Benchmark decontamination by a distributed positional inverted index.

The index is dealt by document: a row is a segment of some documents with the sorted positions of every term in it, so a
document's matches are found in one place and nothing is shuffled. A window of consecutive benchmark words is looked
up from its rarest term in the segment; the offset-adjusted positions of the next terms, in order of frequency, are
intersected until none is left. Benchmark windows go to the executors in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from martwright.llm.ship import lean, shipped
from martwright.llm.store import stored
from martwright.llm.text import ALPHANUMERIC, LOWER, Words, ranges, words_of

#: Bytes of document text in a segment; a longer document is a segment of its own.
SEGMENT_BYTES = (1 << 20) - 64
#: Bytes of benchmark text that are sent to the executors at a time.
BLOCK_BYTES = 8 << 20
#: Positions of the windows' rarest terms that are looked at together.
FRONTIER = 1 << 20

_POSITION_BITS = np.int64(36)
_SEGMENT = ("doc_words", "terms", "lengths", "counts", "positions")


def _terms(words: Words) -> pa.DictionaryArray:
    """The lower-cased words, told apart by their bytes."""
    return ranges(LOWER[words.data], words.starts, words.ends).dictionary_encode()


def packed(words: Words) -> dict[str, bytes]:
    """The documents' words as the fields of a segment."""
    terms = _terms(words)
    code = terms.indices.to_numpy(zero_copy_only=False)
    position = np.arange(len(code)) + words.row_of_words()
    lengths = pc.binary_length(terms.dictionary).to_numpy(zero_copy_only=False)
    numbers = {
        "doc_words": np.diff(words.row_words),
        "lengths": lengths,
        "counts": np.bincount(code, minlength=len(lengths)),
        "positions": position[np.argsort(code, kind="stable")],
    }
    fields = {name: x.astype("<u4").tobytes() for name, x in numbers.items()}
    return fields | {"terms": b"".join(terms.dictionary.to_pylist())}


def positional_index(docs: DataFrame) -> DataFrame:
    """One row per segment: its documents, its terms, and for every term the positions in ascending order.

    Documents stand one after the other, one position apart, so no run of positions spans two of them. Every row of
    ``docs`` is indexed with its whole text; a null text has no words. Rows with equal or null ids stay apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in words_of(batch.column("text"), ALPHANUMERIC, SEGMENT_BYTES):
                segment = packed(words)
                ids = batch.column("doc_id").slice(words.first_row, words.rows)
                columns = [
                    pa.array([ids], pa.list_(batch.schema.field("doc_id").type)),
                    *(pa.array([segment[name]], pa.binary()) for name in _SEGMENT),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_ids", *_SEGMENT])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    return shipped(rows).mapInArrow(
        lean(run), f"doc_ids array<{kind}>, " + ", ".join(f"{name} binary" for name in _SEGMENT)
    )


@dataclass(frozen=True)
class Windows:
    """Distinct windows of benchmark items of up to ``size`` terms; the unused places of a shorter one have no term."""

    size: int
    vocabulary: pa.Array  # distinct terms
    terms: np.ndarray  # windows x size, places in the vocabulary, -1 beyond the window's end
    items: np.ndarray  # item of each occurrence of a window, sorted by window
    item_ends: np.ndarray


def windows_of(texts: list[str | None], size: int) -> Windows:
    """``items`` are places in ``texts``. An item of fewer words, but not none, is one window."""
    found: dict[bytes, set[int]] = {}
    vocabulary: dict[bytes, int] = {}
    for words in words_of(pa.array(texts, pa.string()), ALPHANUMERIC):
        own_terms = _terms(words)
        place = np.array([vocabulary.setdefault(w, len(vocabulary)) for w in own_terms.dictionary.to_pylist()], np.int64)
        term = place[own_terms.indices.to_numpy(zero_copy_only=False)]
        for row in range(words.rows):
            own = term[words.row_words[row] : words.row_words[row + 1]]
            for i in range(max(1, len(own) - size + 1) if len(own) else 0):
                found.setdefault(own[i : i + size].tobytes(), set()).add(words.first_row + row)
    terms = np.full((len(found), size), -1, np.int64)
    for i, window in enumerate(found):
        terms[i, : len(window) // 8] = np.frombuffer(window, np.int64)
    items = [sorted(x) for x in found.values()]
    known = pa.array(list(vocabulary), pa.large_binary())
    return Windows(
        size, known, terms, np.array([x for own in items for x in own], np.int64), np.cumsum([0, *map(len, items)])
    )


@dataclass(frozen=True)
class Segment:
    counts: np.ndarray  # of each vocabulary term
    begins: np.ndarray  # in ``keys``
    keys: np.ndarray  # vocabulary place and position, sorted
    document_starts: np.ndarray


def open_segment(row: dict, vocabulary: pa.Array) -> Segment:
    """The postings of the vocabulary's terms in a segment."""
    counts, positions = np.frombuffer(row["counts"], "<u4").astype(np.int64), np.frombuffer(row["positions"], "<u4")
    offsets = np.concatenate([[0], np.cumsum(np.frombuffer(row["lengths"], "<u4"), dtype=np.int64)])
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(row["terms"])]
    terms = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), buffers)
    ends = np.cumsum(counts)
    at = pc.fill_null(pc.index_in(vocabulary, value_set=terms), -1).to_numpy(zero_copy_only=False)
    there = at >= 0
    own = np.zeros(len(vocabulary), np.int64)
    own[there] = counts[at[there]]
    begins = np.cumsum(own) - own
    place = np.repeat(np.flatnonzero(there), own[there])
    source = np.repeat((ends - counts)[at[there]] - begins[there], own[there]) + np.arange(own.sum())
    words = np.frombuffer(row["doc_words"], "<u4").astype(np.int64)
    starts = np.cumsum(words + 1) - (words + 1)
    return Segment(own, begins, (place.astype(np.int64) << _POSITION_BITS) | positions[source], starts)


def match(segment: Segment, windows: Windows, within: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Windows and positions of their matches.

    Without ``within``: every occurrence of the phrase, with its first position. With it: every position of the
    window's rarest term that has all its other terms at most so many words away in the same document, in any order.
    """
    used = windows.terms >= 0
    counts = np.where(used, segment.counts[windows.terms] if len(windows.vocabulary) else 0, np.iinfo(np.int64).max)
    alive = np.flatnonzero(counts.min(axis=1, initial=np.iinfo(np.int64).max) > 0)
    order = np.argsort(counts[alive], axis=1, kind="stable")  # rarest first, unused places last
    rarest = order[:, 0]
    term = windows.terms[alive, rarest]
    ends = np.cumsum(segment.counts[term])
    found = [
        _matches(segment, windows, within, alive, order, ends, first, min(first + FRONTIER, int(ends[-1])))
        for first in range(0, int(ends[-1]) if len(ends) else 0, FRONTIER)
    ]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    window, position = (np.concatenate(x) for x in zip(*found, strict=True))
    return window, position


def _matches(
    segment: Segment, windows: Windows, within: int | None, alive: np.ndarray, order: np.ndarray, ends: np.ndarray, first: int, last: int
) -> tuple[np.ndarray, np.ndarray]:
    """The matches from the positions ``first`` to ``last`` of all rarest terms' positions, which end at ``ends``."""
    rarest = order[:, 0]
    some = np.arange(np.searchsorted(ends, first, "right"), np.searchsorted(ends, last, "left") + 1)
    term = windows.terms[alive[some], rarest[some]]
    begins = ends[some] - segment.counts[term]
    low, high = np.maximum(begins, first), np.minimum(ends[some], last)
    window = np.repeat(some, high - low)
    source = np.repeat(segment.begins[term] - begins, high - low) + np.arange(first, last)
    position = segment.keys[source] & ((np.int64(1) << _POSITION_BITS) - 1)
    for step in range(1, windows.size):
        place = order[window, step]
        term = windows.terms[alive[window], place]
        if within is None:
            low = high = position + place - rarest[window]
        else:
            document = np.searchsorted(segment.document_starts, position, "right") - 1
            starts = np.append(segment.document_starts, np.iinfo(np.int64).max)
            low, high = np.maximum(position - within, starts[document]), np.minimum(position + within, starts[document + 1] - 1)
        key = np.maximum(term, 0) << _POSITION_BITS
        at = np.searchsorted(segment.keys, key | np.maximum(low, 0))
        found = (at < len(segment.keys)) & (low >= 0 if within is None else True)
        found[found] = segment.keys[at[found]] <= (key | high)[found]
        keep = found | (term < 0)
        window, position = window[keep], position[keep]
    return alive[window], position if within is not None else position - rarest[window]


def _spans(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of ranges, as disjoint ranges in order."""
    order = np.argsort(start, kind="stable")
    start, stop = start[order], np.maximum.accumulate(stop[order])
    new = np.append(True, start[1:] > stop[:-1])[: len(start)]
    return start[new], stop[np.append(new[1:], True)[: len(start)]]


def _search(index: DataFrame, windows: Windows, ids: pa.Array, within: int | None) -> DataFrame:
    sent = index.sparkSession.sparkContext.broadcast((windows, ids))
    doc_type = index.schema["doc_ids"].dataType.elementType.simpleString()
    item_type = "bigint" if pa.types.is_integer(ids.type) else "string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, ids = sent.value
        length = (windows.terms >= 0).sum(axis=1)

        def items_by_document(window: np.ndarray, document: np.ndarray, documents: int) -> pa.Array:
            document, window = np.divmod(np.unique(document * len(windows.terms) + window), max(1, len(windows.terms)))
            n = np.diff(windows.item_ends)[window]
            source = np.repeat(windows.item_ends[:-1][window] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            pairs = np.unique(np.stack([np.repeat(document, n), windows.items[source]]), axis=1)
            ends = np.searchsorted(pairs[0], np.arange(documents + 1))
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids.take(pa.array(pairs[1])))

        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_buffer() for name in _SEGMENT}
                segment = open_segment(row, windows.vocabulary)
                words = np.frombuffer(row["doc_words"], "<u4").astype(np.int64)
                documents = len(words)
                window, position = match(segment, windows)
                document = np.searchsorted(segment.document_starts, position, "right") - 1
                start, stop = _spans(position, position + length[window])
                of = np.searchsorted(segment.document_starts, start, "right") - 1
                ends = np.searchsorted(of, np.arange(documents + 1))
                hits = pa.StructArray.from_arrays(
                    [pa.array(x - segment.document_starts[of]) for x in (start, stop)], names=["start", "stop"]
                )
                columns = [
                    pa.array(np.full(documents, batch.column("segment")[i].as_py())),
                    pa.array(np.arange(documents, dtype=np.int32)),
                    batch.column("doc_ids")[i].values,
                    pa.array(words),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), hits),
                    items_by_document(window, document, documents),
                ]
                if within is None:
                    columns.append(pa.nulls(documents, pa.list_(ids.type)))
                else:
                    window, position = match(segment, windows, within)
                    document = np.searchsorted(segment.document_starts, position, "right") - 1
                    columns.append(items_by_document(window, document, documents))
                yield pa.RecordBatch.from_arrays(columns, names=["segment", "place", "doc_id", "n_words", "hits", "items", "near_items"])

    return shipped(index).mapInArrow(
        lean(run),
        f"segment long, place int, doc_id {doc_type}, n_words long, hits array<struct<start:long,stop:long>>, "
        f"items array<{item_type}>, near_items array<{item_type}>",
    )


def merged_length(hits: Column) -> Column:
    """Positions covered by ranges [start, stop), which may overlap."""
    zero = F.struct(F.lit(0).cast("long").alias("total"), F.lit(-1).cast("long").alias("stop"))
    return F.aggregate(
        F.array_sort(hits),
        zero,
        lambda acc, x: F.struct(
            (acc["total"] + F.greatest(F.lit(0).cast("long"), x["stop"] - F.greatest(x["start"], acc["stop"]))).alias("total"),
            F.greatest(acc["stop"], x["stop"]).alias("stop"),
        ),
        lambda acc: acc["total"],
    )


def contamination(index: DataFrame, items: DataFrame, size: int = 10, within: int | None = None) -> DataFrame:
    """Per document of the index: doc_id, n_words, hits, n_hit, items, near_items.

    ``hits`` are the word ranges inside occurrences of benchmark windows, ``n_hit`` their words, ``items`` the distinct
    ids of the items (item_id, text) they belong to. ``near_items`` has the items with a window whose terms all stand
    at most ``within`` words from an occurrence of its rarest term; null unless asked for. Null texts have no windows;
    windows of an item with a null id mark words, but the id is not listed. Without items or windows nothing is hit.
    """
    index = index.select(F.monotonically_increasing_id().alias("segment"), "doc_ids", *_SEGMENT)
    items = stored(items.select("item_id", F.col("text").cast("string").alias("text")).dropDuplicates())
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // BLOCK_BYTES))
    found = []
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).toArrow()
        ids = own.column("item_id").combine_chunks()
        ids = ids.cast(pa.int64() if pa.types.is_integer(ids.type) else pa.string())
        matches = _search(index, windows_of(own.column("text").to_pylist(), size), ids, within)
        found.append(matches if blocks == 1 else stored(matches))  # so that the driver and executors hold one block
    rows = found[0]
    if blocks > 1:
        for other in found[1:]:
            rows = rows.unionByName(other)
        rows = rows.groupBy("segment", "place").agg(
            F.first("doc_id").alias("doc_id"),
            F.max("n_words").alias("n_words"),
            *(F.flatten(F.collect_list(name)).alias(name) for name in ("hits", "items", "near_items")),
        )
    near = F.array_distinct(F.array_compact("near_items")) if within is not None else F.col("near_items")
    return rows.select(
        "doc_id",
        "n_words",
        "hits",
        merged_length(F.col("hits")).alias("n_hit"),
        F.array_distinct(F.array_compact("items")).alias("items"),
        near.alias("near_items"),
    )
