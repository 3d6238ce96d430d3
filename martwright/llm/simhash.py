"""SimHash near-duplicates: 64-bit fingerprints, linked by BK-trees.

A BK-tree keeps the children of a node by their integer Hamming distance to it; a search follows only the edges whose
distance lies within the radius of the query's own distance to the node. A single set of trees that every fingerprint
searches would cost the product of both, so trees are built over shards that a link cannot leave: fingerprints at
most r bits apart agree in at least two of r + 2 bands, hence in one shard for a pair of bands. A shard with many
fingerprints is cut into chunks; the tree of each chunk is sent to every chunk of the shard. A search emits a star over
the linked fingerprints it has found, not their pairs, and the stars are joined to components.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from martwright.llm.components import components
from martwright.llm.ship import lean, shipped
from martwright.llm.store import stored
from martwright.llm.text import as_bytes

BITS = 64
#: Bytes of a text whose words are looked at together, about.
PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
#: Fingerprints in a tree, and in the part of a shard that searches it.
CHUNK = 8192
#: Pairs of query and node that are looked at together.
FRONTIER = 2 << 20


def _pieces(text: bytes) -> Iterator[bytes]:
    """``text`` cut where it has white space, into pieces of about ``PIECE`` bytes."""
    start = 0
    while start < len(text):
        found = _SPACE.search(text, start + PIECE)
        end = found.start() if found else len(text)
        yield text[start:end]
        start = end


def _hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of all runs of ``size`` of the words, joined by a space; as rows of bytes."""
    import xxhash

    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], 42) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)],
        "<u8",
    )
    return hashes.view(np.uint8).reshape(-1, 8)


def fingerprint(text: bytes, shingle: int) -> int:
    """Majority bits of the XXH64 of all shingles; 0 for a text without words. Long texts are worked off in pieces."""
    counts, total = np.zeros(BITS, np.int64), 0
    words: list[bytes] = []
    for piece in _pieces(text):
        words += piece.lower().split()
        if len(words) >= shingle:
            hashes = _hashes(words, shingle)
            counts += np.unpackbits(hashes, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            total += len(hashes)
            words = words[len(words) - shingle + 1 :]
    if not total:
        if not words:
            return 0
        counts, total = np.unpackbits(_hashes(words, len(words)), axis=1, bitorder="little").sum(axis=0, dtype=np.int64), 1
    return int.from_bytes(np.packbits(counts * 2 > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fingerprint as a signed long) for every row of ``docs``; whole texts, a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = as_bytes(batch.column("text"))
            found = np.array(
                [fingerprint(data[a:b].tobytes(), shingle) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], np.uint64
            )
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "fingerprint"])

    rows = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fingerprint long"
    return shipped(rows).mapInArrow(lean(run), schema)


class Forest:
    """BK-trees of many groups at once; ``group`` is sorted, and a group's first value is its root."""

    def __init__(self, values: np.ndarray, group: np.ndarray) -> None:
        self.values = values
        n = len(values)
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1])[:n])
        self.roots, self.root_groups = first, group[first]
        edges: list[np.ndarray] = []
        children: list[np.ndarray] = []
        rest = np.setdiff1d(np.arange(n), first, assume_unique=True)
        at = first[np.searchsorted(self.root_groups, group[rest])]
        while len(rest):
            edge = at * (BITS + 1) + np.bitwise_count(values[rest] ^ values[at])
            taken, earliest, which = np.unique(edge, return_index=True, return_inverse=True)
            edges.append(taken)
            children.append(rest[earliest])
            below = np.ones(len(rest), bool)
            below[earliest] = False
            at, rest = rest[earliest][which][below], rest[below]
        edge = np.concatenate(edges) if edges else np.zeros(0, np.int64)
        order = np.argsort(edge)
        self.edges = edge[order]
        self.children = np.concatenate(children)[order] if children else np.zeros(0, np.int64)

    def search(self, queries: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of queries and of values in the tree of the same group that are at most ``radius`` apart."""
        if not len(self.roots):
            return
        at = np.minimum(np.searchsorted(self.root_groups, group), len(self.roots) - 1)
        query = np.flatnonzero(self.root_groups[at] == group)
        node = self.roots[at[query]]
        while len(query):
            distance = np.bitwise_count(queries[query] ^ self.values[node]).astype(np.int64)
            hit = distance <= radius
            yield query[hit], node[hit]
            low = np.searchsorted(self.edges, node * (BITS + 1) + np.maximum(distance - radius, 0))
            high = np.searchsorted(self.edges, node * (BITS + 1) + np.minimum(distance + radius, BITS), "right")
            n = high - low
            query = np.repeat(query, n)
            node = self.children[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def _links(key: np.ndarray, value: np.ndarray, in_tree: np.ndarray, asks: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A star over each set of linked values within a group: values and the smallest of their set, without the centres."""
    order = np.argsort(key, kind="stable")
    key, value, in_tree, asks = key[order], value[order], in_tree[order], asks[order]
    group = np.cumsum(np.append(False, key[1:] != key[:-1]))
    tree, ask = np.flatnonzero(in_tree), np.flatnonzero(asks)
    forest = Forest(value[tree], group[tree])
    trees = np.bincount(group[tree], minlength=group[-1] + 1)
    load = np.cumsum(trees[group[ask]])
    label = np.arange(len(value))
    begin = 0
    while begin < len(ask):
        done = load[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(load, done + FRONTIER, "right")))
        some = ask[begin:end]
        for query, node in forest.search(value[some], group[some], radius):
            a, b = some[query], tree[node]
            while True:  # hook the larger root under the smaller one until both ends agree
                ra, rb = label[a], label[b]
                differ = ra != rb
                if not differ.any():
                    break
                a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
                np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))
                while (label[label] != label).any():
                    label = label[label]
        begin = end
    smallest = np.full(len(value), np.iinfo(np.int64).max)
    signed = value.view(np.int64)
    np.minimum.at(smallest, label, signed)
    centre = smallest[label]
    leaf = centre != signed
    return signed[leaf], centre[leaf]


def links(values: DataFrame, radius: int) -> DataFrame:
    """Edges (u, v) that connect all distinct fingerprints of ``values`` (fingerprint) at most ``radius`` bits apart."""
    bands = radius + 2
    cuts = [BITS * i // bands for i in range(bands + 1)]
    masks = [(1 << cuts[i + 1]) - (1 << cuts[i]) for i in range(bands)]
    signed = lambda mask: mask - (1 << 64) if mask >> 63 else mask
    keys = [
        F.struct(F.lit(i).alias("pair"), F.col("fingerprint").bitwiseAND(F.lit(signed(a | b))).alias("bits"))
        for i, (a, b) in enumerate(combinations(masks, 2))
    ]
    members = values.select("fingerprint", F.explode(F.array(*keys)).alias("key")).select("fingerprint", "key.pair", "key.bits")
    crowded = members.groupBy("pair", "bits").agg(F.count("*").alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    placed = members.join(crowded, ["pair", "bits"]).select(
        "pair", "bits", "fingerprint", chunks.alias("chunks"), F.pmod(F.xxhash64("fingerprint"), chunks).cast("int").alias("chunk")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    sent = placed.select("*", other).select(
        "pair",
        "bits",
        F.least("chunk", "other").alias("tree"),
        F.greatest("chunk", "other").alias("asks"),
        "fingerprint",
        (F.col("chunk") <= F.col("other")).alias("in_tree"),
        (F.col("chunk") >= F.col("other")).alias("is_query"),
    )
    shard = ["pair", "bits", "tree", "asks"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, shard):
            key = np.cumsum(_new_group(table, shard))
            u, v = _links(
                key,
                table.column("fingerprint").to_numpy().view(np.uint64),
                table.column("in_tree").to_numpy(zero_copy_only=False),
                table.column("is_query").to_numpy(zero_copy_only=False),
                radius,
            )
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    grouped = sent.repartition(*shard).sortWithinPartitions(*shard)
    return shipped(grouped).mapInArrow(lean(search), "u long, v long")


def _new_group(table: pa.Table, columns: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    for name in columns:
        value = table.column(name).to_numpy()
        new[1:] |= value[1:] != value[:-1]
    return new


def _whole_groups(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.Table]:
    """The rows of sorted batches, cut between groups."""
    waiting: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        joined = pa.concat_tables([waiting[-1].slice(waiting[-1].num_rows - 1), table]) if waiting else table
        new = np.flatnonzero(_new_group(joined, columns))
        if not len(new):
            waiting.append(table)
            continue
        cut = int(new[-1]) - (1 if waiting else 0)
        yield pa.concat_tables([*waiting, table.slice(0, cut)]).combine_chunks()
        waiting = [table.slice(cut)]
    if sum(t.num_rows for t in waiting):
        yield pa.concat_tables(waiting).combine_chunks()


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per row of ``docs`` (doc_id, text).

    ``fingerprint`` is a signed long, ``component_id`` the smallest doc_id that links reach, the row's own included. Texts
    without words (null, empty, blank) have fingerprint 0 and are linked like others. Null ids keep their rows but are
    no component's id unless it has no other; repeated ids are one document in several rows.
    """
    marked = stored(fingerprints(docs, shingle))
    values = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("smallest"))
    roots = components(links(values.select("fingerprint"), radius))
    rooted = values.join(roots, values["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "smallest", F.coalesce("root", "fingerprint").alias("root")
    )
    rooted = stored(rooted)
    named = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    classes = rooted.join(named, "root").select("fingerprint", "component_id")
    return marked.join(classes, "fingerprint").select("doc_id", "fingerprint", "component_id")
