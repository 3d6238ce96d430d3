"""Byte-level BPE: encoding and decoding with a vocabulary of ranks.

Encoding looks a pre-token up in two tiers. A minimal perfect hash over the vocabulary resolves whole pre-tokens that
are tokens; the others are merged with a heap over a linked list of their bytes, lowest rank first, leftmost among
equals. Both tiers work on the distinct pre-tokens of a chunk of texts; results of the second tier are kept in a
bounded memo per worker. Rows are independent, so there is no shuffle; the vocabulary, whose size is known and bounded,
is read once by the driver and travels with the function.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from martwright.llm.ship import lean, shipped
from martwright.llm.text import as_bytes, row_chunks

#: A vocabulary beyond this many tokens is refused, as it is sent to every executor.
MOST_TOKENS = 1_000_000
#: Pre-tokens in each of a worker's two memos. When the newer one is full it becomes the older one, and those of the older
#: one that were not met since are forgotten.
MEMO_ENTRIES = 150_000
#: Longer pre-tokens are merged but not remembered.
MEMO_BYTES = 64
CHUNK_BYTES = 1 << 20
#: Longer texts, and more tokens, are worked off in runs of so many pre-tokens or tokens.
LONG = 1 << 18

_MASK = (1 << 64) - 1


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a file of lines "base64 rank"."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
    if len(ranks) > MOST_TOKENS:
        raise ValueError(f"{len(ranks)} tokens; at most {MOST_TOKENS} are sent to the executors")
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"bytes without a token: {missing[:5]}")
    return ranks


def _key(token: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(token, digest_size=8).digest(), "little")


def _slot(key: int, pilot: int, size: int) -> int:
    x = (key ^ (pilot * 0x9E3779B97F4A7C15)) & _MASK
    x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & _MASK
    return (x ^ (x >> 29)) % size


@dataclass
class PerfectHash:
    """Hash and displace: a bucket's pilot sends its keys to slots that no other key has; as many slots as keys."""

    pilots: list[int]
    tokens: list[bytes]
    ranks: list[int]

    @classmethod
    def build(cls, ranks: dict[bytes, int]) -> PerfectHash:
        size = len(ranks)
        buckets: list[list[tuple[int, bytes]]] = [[] for _ in range(max(1, size // 3))]
        for token in ranks:
            key = _key(token)
            buckets[key % len(buckets)].append((key, token))
        pilots, taken = [0] * len(buckets), [False] * size
        tokens: list[bytes] = [b""] * size
        for b in sorted(range(len(buckets)), key=lambda i: -len(buckets[i])):
            pilot = 0
            while True:
                slots = [_slot(key, pilot, size) for key, _ in buckets[b]]
                if len(set(slots)) == len(slots) and not any(taken[s] for s in slots):
                    break
                pilot += 1
            pilots[b] = pilot
            for s, (_, token) in zip(slots, buckets[b], strict=True):
                taken[s], tokens[s] = True, token
        return cls(pilots, tokens, [ranks[t] for t in tokens])

    def get(self, piece: bytes) -> int | None:
        key = _key(piece)
        slot = _slot(key, self.pilots[key % len(self.pilots)], len(self.tokens))
        return self.ranks[slot] if self.tokens[slot] == piece else None


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a piece: the adjacent pair of lowest rank is merged first, the leftmost of equals, until none is left."""
    n = len(piece)
    end = list(range(1, n + 1))  # end[i]: where the part that begins at i ends; 0 once it is merged into another
    before = list(range(-1, n))
    heap = []
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapify(heap)
    while heap:
        rank, i, stop = heappop(heap)
        middle = end[i]
        if not middle or middle >= n or end[middle] != stop:
            continue  # one of the two parts has changed since
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            rank = ranks.get(piece[i : end[stop]])
            if rank is not None:
                heappush(heap, (rank, i, end[stop]))
        left = before[i]
        if left >= 0:
            rank = ranks.get(piece[left:stop])
            if rank is not None:
                heappush(heap, (rank, left, stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


class Codec:
    """Encoder of one worker; ids are little-endian unsigned 32-bit integers in a row."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, hashed: PerfectHash) -> None:
        import regex

        self.pattern = regex.compile(pattern)
        self.ranks = ranks
        self.hashed = hashed
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def piece(self, text: str) -> bytes:
        """The ids of a pre-token that is not in the newer memo."""
        known = self.older.get(text)
        if known is not None:
            self.remember(text, known)
            return known
        raw = text.encode("utf-8", "surrogatepass")
        rank = self.hashed.get(raw)
        ids = array("I", [rank] if rank is not None else merge(raw, self.ranks))
        if sys.byteorder == "big":
            ids.byteswap()
        packed = ids.tobytes()
        if len(raw) <= MEMO_BYTES:
            self.remember(text, packed)
        return packed

    def remember(self, text: str, packed: bytes) -> None:
        if len(self.memo) >= MEMO_ENTRIES:
            self.older, self.memo = self.memo, {}
        self.memo[text] = packed

    def encode(self, text: str) -> bytes:
        known = self.memo.get
        if len(text) <= LONG:
            return b"".join([known(piece) or self.piece(piece) for piece in self.pattern.findall(text)])
        found = (match.group() for match in self.pattern.finditer(text))  # so that not all of them are held
        runs = iter(lambda: b"".join([known(piece) or self.piece(piece) for piece in islice(found, LONG)]), b"")
        return b"".join(runs)


_codecs: dict[tuple[int, str], Codec] = {}


class Tokenizer:
    """A vocabulary file and a pre-token pattern; sent to the executors once for each task's function."""

    def __init__(self, path: str, pattern: str) -> None:
        self.ranks, self.pattern = read_ranks(path), pattern
        self.hashed = PerfectHash.build(self.ranks)
        self.key = (hash((len(self.ranks), path)), pattern)

    def tokens(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids in their order, and the length of each."""
        table = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            table[rank] = token
        return np.frombuffer(b"".join(table), np.uint8), np.array([len(t) for t in table], np.int64)

    def codec(self) -> Codec:
        """The worker's own codec, whose memo lasts over its tasks."""
        if self.key not in _codecs:
            _codecs.clear()
            _codecs[self.key] = Codec(self.ranks, self.pattern, self.hashed)
        return _codecs[self.key]


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, buffers).cast(pa.binary())


def encode(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """(doc_id, n_tokens, ids) of each whole text; ``ids`` are little-endian unsigned 32-bit integers in a row.

    A null text has no tokens. One row per row, repeated rows and null ids too; other columns are dropped.
    """
    sent = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = sent.value.codec()
        for batch in batches:
            texts = batch.column("text")
            for a, b in row_chunks(as_bytes(texts)[1], CHUNK_BYTES):
                ids = [codec.encode(text) if text else b"" for text in texts.slice(a, b - a).to_pylist()]
                columns = [
                    batch.column("doc_id").slice(a, b - a),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids"])

    rows = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary"
    return shipped(rows).mapInArrow(lean(run), schema)


def decode(encoded: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """``encoded`` (doc_id, n_tokens, ids) with the column ``decoded``, the bytes of the ids; null ids give no bytes."""
    sent = encoded.sparkSession.sparkContext.broadcast(tokenizer.tokens())
    names = ["doc_id", "n_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat, lengths = sent.value
        starts = np.cumsum(lengths) - lengths
        for batch in batches:
            data, offsets = as_bytes(batch.column("ids"))
            for a, b in row_chunks(offsets, CHUNK_BYTES):
                ids = np.frombuffer(data[offsets[a] : offsets[b]].tobytes(), "<u4")
                size = lengths[ids]
                into = np.concatenate([[0], np.cumsum(size)])
                decoded = np.empty(into[-1], np.uint8)
                for first in range(0, len(ids), LONG):
                    last = min(first + LONG, len(ids))
                    low, high = into[first], into[last]
                    source = np.repeat(starts[ids[first:last]] - into[first:last], size[first:last]) + np.arange(low, high)
                    decoded[low:high] = flat[source]
                part = batch.slice(a, b - a)
                columns = [part.column(name) for name in names]
                columns.append(_binary(decoded, into[(offsets[a : b + 1] - offsets[a]) // 4]))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, "decoded"])

    schema = f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary, decoded binary"
    return shipped(encoded.select(*names)).mapInArrow(lean(run), schema)
