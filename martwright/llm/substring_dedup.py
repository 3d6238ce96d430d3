"""Exact substring deduplication with fixed-block anchors.

A run of words that two texts share, at least ``window`` words long, holds a whole block of ``window // 2`` words that
begins at a multiple of that length in one of them. So the index has the non-overlapping blocks of every text, and the
probes are all rolling windows of a block's length. A probe that meets a block of another place is an anchor. The
windows of full length around the anchors are then compared among themselves: a window whose word sequence also
starts in a document with a smaller id is part of a repeat, and the union of such windows are the maximal exact
repeats.

Anchors are found by a hash, which only chooses the windows that are looked at; windows are equal if 96-bit digests of
their words are (BLAKE2b), which no two unequal ones that anyone can make have in common.

Only hashes and digests are shuffled, packed (``hops``): a row of the shuffle has those of one hash bucket and one chunk of
texts, as an array, or of a range of buckets where there are very many.
They are counted before: a chunk of texts sends a probe at most twice, and what one task has read (a shard) sends a window
once, with its smallest id. So a window that very many documents share, or a text of one word, is a few entries of its
bucket for each chunk. Hashes that decide go back to the shards that have them, which find their places anew. The texts
themselves are not shuffled: they are written once, as a table bucketed by the task that read them, and later steps
meet them there.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import Window
from pyspark.sql.types import IntegralType

from martwright.llm.hops import DDL, SCHEMA, Way, runs
from martwright.llm.ship import lean, lean_group, shipped
from martwright.llm.store import stored
from martwright.llm.text import NOT_SPACE, Hasher, Words, digests, words_of
from martwright.sources.scratch import scratch_dir

#: Windows in a hash bucket, about.
BUCKET_WINDOWS = 16_000_000
CHUNK_BYTES = (2 << 20) - 64
#: Text of a shard, about, which two of the steps hold in one worker; and how many times as large texts are as their files.
SHARD_BYTES = 256 << 20
_UNPACKED = 4

_anchor = Hasher(51)
_full = Hasher(52)
_LAST = (1 << 63) - 1


def _order(docs: DataFrame) -> DataFrame:
    """(id, doc_id, text): ``id`` is a long in the order of doc_id; a null doc_id is the largest.

    Whole numbers are their own; other ids, such as text, are numbered in the order of their type.
    """
    rows = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    if isinstance(docs.schema["doc_id"].dataType, IntegralType):
        return rows.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id"), "doc_id", "text")
    ids = rows.select(F.col("doc_id").alias("own")).where("own is not null").distinct().orderBy("own")
    numbered = stored(ids.select("own", F.monotonically_increasing_id().alias("number")))
    known = rows.join(numbered, rows["doc_id"] == numbered["own"], "left")
    return known.select(F.coalesce("number", F.lit(_LAST)).alias("id"), "doc_id", "text")


def _shards(docs: DataFrame) -> tuple[DataFrame, int, int, int]:
    """(shard, place, id, doc_id, text) as a bucketed table sorted by shard, its bytes of text, the number of shards, and a
    number that those of the shards are below.

    A shard is what one task has read, or one of several equal parts of it where tasks may read more than
    ``SHARD_BYTES``. Its number is chosen so that the shards spread evenly over the buckets. The numbers reach the tasks as
    a table of a row for each shard.
    """
    spark = docs.sparkSession
    rows = _order(docs)
    in_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    each = max(1, -(-_UNPACKED * in_bytes(str(spark.conf.get("spark.sql.files.maxPartitionBytes"))) // SHARD_BYTES))
    shards = max(1, rows.rdd.getNumPartitions()) * each
    buckets = min(shards, 4096)
    most = 40 * shards + 1000
    candidate = spark.range(most).select(F.col("id").cast("int").alias("shard"))
    candidate = candidate.withColumn("bucket", F.pmod(F.hash("shard"), F.lit(buckets)))
    candidate = candidate.withColumn("round", F.row_number().over(Window.partitionBy("bucket").orderBy("shard")) - 1)
    numbered = candidate.withColumn("number", F.col("round") * buckets + F.col("bucket")).where(F.col("number") < shards)
    place = F.monotonically_increasing_id()
    read = rows.select(
        # adaptive execution may have more tasks than were counted: they share shards
        F.pmod(F.spark_partition_id() * each + F.pmod(F.xxhash64(place), F.lit(each)), F.lit(shards)).cast("int").alias("number"),
        place.bitwiseAND(F.lit((1 << 33) - 1)).alias("place"),
        "id",
        "doc_id",
        "text",
    )
    path = scratch_dir(spark)
    database = f"martwright_{uuid4().hex}"
    spark.sql(f"create database `{database}`")
    try:
        (
            read.join(F.broadcast(numbered.select("number", "shard")), "number")
            .select("shard", "place", "id", "doc_id", "text")
            .write.format("parquet")
            .option("path", path)
            .option("compression", "zstd")
            .bucketBy(buckets, "shard")
            .sortBy("shard")
            .saveAsTable(f"`{database}`.`shards`")
        )
        table = spark.table(f"`{database}`.`shards`")
    finally:  # the files stay, which the plan names by itself
        spark.sql(f"drop database `{database}` cascade")
    total = table.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return table, total, shards, most


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Of 64-bit hashes."""
    return (hashes >> np.uint64(32)) % np.uint64(buckets)


def _positions(words: Words) -> np.ndarray:
    return np.arange(len(words.starts)) - np.repeat(words.row_words[:-1], np.diff(words.row_words))


def _probe_hashes(words: Words, block: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the windows of block length begin, and of each the bucket and 31 bits of the hash beside the bucket's."""
    start = np.flatnonzero(words.window_starts(block))
    hashes = _anchor.windows(_anchor.spans(words.data, words.starts, words.ends), block)[start]
    return start, _bucket(hashes, buckets) << np.uint64(31) | hashes & np.uint64(0x7FFFFFFF)


def _probes(block: int, buckets: int, way: Way):
    """Rolling windows of block length, and whether they are indexed blocks: of equal ones of a chunk the first and last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            for words in words_of(batch.column("text"), NOT_SPACE, CHUNK_BYTES):
                start, keys = _probe_hashes(words, block, buckets)
                shard = shards[words.row_of_words()[start] + words.first_row]
                entry = keys << np.uint64(1) | (_positions(words)[start] % block == 0).astype(np.uint64)
                rows = []
                borders = runs(shard)
                for a, b in zip(borders[:-1], borders[1:], strict=True):
                    sent = np.sort(entry[a:b])  # equal hashes together, indexed blocks last
                    ends = runs(sent >> np.uint64(1))
                    sent = sent[np.unique(np.concatenate((ends[:-1], ends[1:] - 1)))]
                    rows += way.rows((sent >> np.uint64(32)).astype(np.int64), int(shard[a]), sent.astype("<u4"))
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=SCHEMA)

    return run


def _anchors(probes: Way, way: Way):
    """To each shard its probes of a bucket that meet an indexed block at another place, as bucket and 31 bits."""

    def run(table: pa.Table) -> pa.Table:
        shard, entries, _ = probes.unpacked(table)
        bucket = np.uint64(table.column("target")[0].as_py())
        every = np.sort(entries)
        ends = runs(every >> 1)
        found = every[ends[:-1]][(np.diff(ends) > 1) & (every[ends[1:] - 1] & 1 == 1)] >> 1
        hit = _among(entries >> 1, found)[0]
        own = np.unique(shard[hit].astype(np.uint64) << np.uint64(32) | (entries[hit] >> 1))
        keys = bucket << np.uint64(31) | own & np.uint64(0x7FFFFFFF)
        return pa.Table.from_pylist(way.rows((own >> np.uint64(32)).astype(np.int64), 0, keys), schema=SCHEMA)

    return run


def _among(values: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each of ``values`` is one of the sorted ``known``, and its place there if so."""
    if not len(known):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values, at


def _words_of(texts: pa.Table) -> Iterator[tuple[int, Words]]:
    """The words of all rows, chunk by chunk, and the chunk's first row."""
    row = 0
    for part in texts.column("text").chunks:
        for words in words_of(part, NOT_SPACE, CHUNK_BYTES):
            yield row + words.first_row, words
        row += len(part)


#: A window as 16 bytes: 4 of a rolling hash, by which it is looked for, and a digest of 12 (BLAKE2b), which tells it
#: from every other window.
_ENTRY = "S16"


def _quick(words: Words, window: int, start: np.ndarray) -> np.ndarray:
    return _full.windows(_full.spans(words.data, words.starts, words.ends), window)[start].astype("<u4")


def _window_entries(words: Words, window: int, start: np.ndarray, quick: np.ndarray) -> np.ndarray:
    digest = digests(words, start, window, 12)
    return np.hstack([quick.view(np.uint8).reshape(-1, 4), digest]).view(_ENTRY).ravel()


def _digest_bucket(entries: np.ndarray, buckets: int) -> np.ndarray:
    return _bucket(np.ascontiguousarray(entries.view(np.uint8).reshape(-1, 16)[:, 4:12]).view("<u8").ravel(), buckets)


def _summed(hashes: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes with the least and the most."""
    if not len(hashes):
        return hashes, least, most
    order = np.argsort(hashes)
    ends = runs(hashes[order])
    first = ends[:-1]
    return hashes[order][first], np.minimum.reduceat(least[order], first), np.maximum.reduceat(most[order], first)


def _windows(window: int, block: int, buckets: int, keyed: Way, way: Way):
    """The distinct full windows around the anchors of a shard, with the smallest id and whether there are several."""

    def run(texts: pa.Table, anchors: pa.Table) -> pa.Table:
        if not anchors.num_rows or not texts.num_rows:
            return SCHEMA.empty_table()
        found = np.unique(keyed.unpacked(anchors)[1])
        ids = texts.column("id").to_numpy()
        seen = (np.zeros(0, _ENTRY), np.zeros(0, np.int64), np.zeros(0, np.int64))
        waiting, size = [], 0
        for first_row, words in _words_of(texts):
            start, keys = _probe_hashes(words, block, buckets)
            anchor = start[_among(keys, found)[0]]
            if not len(anchor):
                continue
            position = _positions(words)
            change = np.zeros(len(words.starts) + 1, np.int64)
            np.add.at(change, anchor - np.minimum(position[anchor], window - block), 1)
            np.add.at(change, anchor + 1, -1)
            start = np.flatnonzero((np.cumsum(change[:-1]) > 0) & words.window_starts(window))
            own = ids[words.row_of_words()[start] + first_row]
            waiting.append(_summed(_window_entries(words, window, start, _quick(words, window, start)), own, own))
            size += len(waiting[-1][0])
            if size > len(seen[0]) + BUCKET_WINDOWS:
                seen, waiting, size = _summed(*(np.concatenate(x) for x in zip(seen, *waiting, strict=True))), [], 0
        hashes, least, most = _summed(*(np.concatenate(x) for x in zip(seen, *waiting, strict=True)))
        bucket, shard = _digest_bucket(hashes, buckets).astype(np.int64), texts.column("shard")[0].as_py()
        return pa.Table.from_pylist(way.rows(bucket, shard, hashes, ids=least, several=most > least), schema=SCHEMA)

    return run


def _repeats(windows: Way, way: Way):
    """To each shard its windows of a bucket that also start in a document with a smaller id, and that id."""

    def run(table: pa.Table) -> pa.Table:
        shard, entries, more = windows.unpacked(table)
        least, several = more["ids"], more["several"]
        known, smallest, _ = _summed(entries, least, least)
        first = smallest[np.searchsorted(known, entries)]
        keep = several | (least > first)
        return pa.Table.from_pylist(way.rows(shard[keep].astype(np.int64), 0, entries[keep], ids=first[keep]), schema=SCHEMA)

    return run


def _cut(window: int, doc_type: pa.DataType, way: Way):
    """Rows of a shard without the words in repeats."""
    schema = pa.schema(
        [pa.field("doc_id", doc_type), pa.field("n_words", pa.int64()), pa.field("n_removed", pa.int64()), pa.field("kept", pa.string())]
    )

    def run(texts: pa.Table, repeats: pa.Table) -> pa.Table:
        known, quick, smallest = np.zeros(0, _ENTRY), np.zeros(0, "<u4"), np.zeros(0, np.int64)
        if repeats.num_rows:
            _, known, more = way.unpacked(repeats)
            order = np.argsort(known)
            known, smallest = known[order], more["ids"][order]
            quick = np.unique(np.ascontiguousarray(known.view(np.uint8).reshape(-1, 16)[:, :4]).view("<u4").ravel())
        ids = texts.column("id").to_numpy()
        n_words, n_removed, kept = [], [], []
        for first_row, chunk in _words_of(texts):
            row, position = np.zeros(0, np.int64), np.zeros(0, np.int64)
            if len(known):
                start = np.flatnonzero(chunk.window_starts(window))
                own = _quick(chunk, window, start)
                likely = _among(own, quick)[0]
                start = start[likely]
                found, at = _among(_window_entries(chunk, window, start, own[likely]), known)
                start, at = start[found], at[found]
                row = chunk.row_of_words()[start]
                later = ids[row + first_row] > smallest[at]
                row, position = row[later], _positions(chunk)[start[later]]
            begin, end = (np.searchsorted(row, np.arange(chunk.rows), side) for side in ("left", "right"))
            for text, a, b in zip(texts.column("text").slice(first_row, chunk.rows), begin.tolist(), end.tolist(), strict=True):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                n_words.append(len(words))
                if a < b:
                    change = np.zeros(len(words) + 1, np.int64)
                    change[position[a:b]] += 1
                    np.subtract.at(change, position[a:b] + window, 1)
                    keep = np.cumsum(change[:-1]) == 0
                    words = list(compress(words, keep.tolist()))
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
        text = pa.array(kept, pa.binary()).cast(pa.string())
        counts = [pa.array(x, pa.int64()) for x in (n_words, n_removed)]
        return pa.Table.from_arrays([texts.column("doc_id"), *counts, text], schema=schema)

    return run


def without_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) for every row of ``docs`` (doc_id, text): the words outside repeats.

    Words are runs of other characters than ASCII white space; ``kept`` joins them by one space. A word goes if a window
    of ``window`` words covers it whose word sequence also starts in a document with a smaller doc_id, as the input has
    it. Ids are compared in the order of their type; a null id is larger than all others, and rows with the same id (or
    with null) are one document, which repeats nothing of its own. Null texts have no words. Other columns are dropped.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    block = window // 2
    doc_type = docs.schema["doc_id"].dataType
    texts, total, shards, span = _shards(docs)
    shipped(texts)
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // (6 * BUCKET_WINDOWS)))
    to_bucket = {kind: Way.to(buckets, buckets, kind) for kind in ("<u4", _ENTRY)}
    to_shard = {kind: Way.to(shards, span, kind) for kind in ("<u8", _ENTRY)}
    by_shard = texts.groupBy("shard")

    probes = texts.select("shard", "text").mapInArrow(lean(_probes(block, buckets, to_bucket["<u4"])), DDL)
    met = to_bucket["<u4"].arrived(probes).groupBy("target")
    anchors = met.applyInArrow(lean_group(_anchors(to_bucket["<u4"], to_shard["<u8"])), DDL)
    asked = to_shard["<u8"].arrived(anchors).groupBy("target")
    found = by_shard.cogroup(asked).applyInArrow(
        lean_group(_windows(window, block, buckets, to_shard["<u8"], to_bucket[_ENTRY])), DDL
    )
    compared = to_bucket[_ENTRY].arrived(found).groupBy("target")
    repeats = compared.applyInArrow(lean_group(_repeats(to_bucket[_ENTRY], to_shard[_ENTRY])), DDL)
    gone = to_shard[_ENTRY].arrived(repeats).groupBy("target")
    return by_shard.cogroup(gone).applyInArrow(
        lean_group(_cut(window, to_arrow_type(doc_type), to_shard[_ENTRY])),
        f"doc_id {doc_type.simpleString()}, n_words long, n_removed long, kept string",
    )
