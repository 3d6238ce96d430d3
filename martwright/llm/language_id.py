"""Language identification with bit-sliced Bloom filters of character n-grams.

Every slot of one table holds a mask with a bit for each language; the conjunction of an n-gram's slots is the set of all
languages whose filter contains it, found at once. A text's n-grams are counted by language, the counts are corrected
for the filters' false positives, and the largest share decides. Scoring is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martwright.llm.linear import bounded_classes
from martwright.llm.ship import lean, shipped
from martwright.llm.text import LETTER, LOWER, Hasher, as_bytes, mix, row_chunks

#: Documents that a model is fitted on at most (about: they are chosen by a hash of the id), an equal share of each language
#: or all of one that has fewer.
FIT_ROWS = 16_000
#: Bytes in an n-gram; every run of other bytes than letters is one space, and words are padded by it.
SIZES = (3, 4)
#: An n-gram belongs to a language if this share of its documents has it ...
LEAST_RATE = 0.005
#: ... and no other language has it so many times as often.
LEAST_SHARE = 0.2
HASHES = 2
#: Slots for each n-gram of the largest language.
SLOTS = 12
UNKNOWN = "und"

_CHUNK = 1 << 19
_grams = Hasher(31)


def ngrams(data: np.ndarray, row_bytes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of all n-grams of each size, and their rows."""
    letter = LETTER[data]
    # one space in front of every row and for every run of other bytes
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    kept = np.flatnonzero(keep)
    code = np.where(letter[kept], LOWER[data[kept]], 32).astype(np.uint8)
    row = np.searchsorted(row_bytes, kept, "right") - 1
    fronts = np.searchsorted(kept, row_bytes[:-1])
    code, row = np.insert(code, fronts, 32), np.insert(row, fronts, np.arange(len(row_bytes) - 1))
    code, row = np.append(code, 32).astype(np.uint8), np.append(row, len(row_bytes) - 1)
    values = _grams.byte_values[code]
    for size in SIZES:
        n = max(0, len(code) - size + 1)
        starts = np.arange(n)
        inside = (row[:n] == row[size - 1 :]) & (code[1 : n + 1] != 32)
        hashes = mix(_grams._ranges(values, starts, starts + size) + np.uint64(size))
        yield hashes[inside], row[:n][inside]


@dataclass(frozen=True)
class LanguageFilters:
    languages: list[str]
    table: np.ndarray = field(repr=False)  # slots x bytes of the language mask
    false_positive: np.ndarray = field(repr=False)

    def slots(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        for i in range(HASHES):
            yield (mix(hashes + np.uint64(i * 0x9E3779B97F4A7C15 & (2**64 - 1))) & np.uint64(len(self.table) - 1)).astype(np.int64)

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """For each n-gram the mask of the languages whose filter contains it."""
        found = None
        for slot in self.slots(hashes):
            found = self.table[slot] if found is None else found & self.table[slot]
        return found


def build(languages: list[str], hashes: np.ndarray, masks: np.ndarray) -> LanguageFilters:
    """``masks``: for each n-gram the bytes of its language mask, lowest bit first."""
    most = int(np.unpackbits(masks, axis=1, bitorder="little").sum(axis=0).max(initial=1)) if len(masks) else 1
    table = np.zeros((1 << max(10, (SLOTS * most - 1).bit_length()), max(1, -(-len(languages) // 8))), np.uint8)
    empty = LanguageFilters(languages, table, np.zeros(len(languages)))
    for slot in empty.slots(hashes):
        np.bitwise_or.at(table, slot, masks)
    fill = np.unpackbits(table, axis=1, bitorder="little")[:, : len(languages)].mean(axis=0)
    return LanguageFilters(languages, table, fill**HASHES)


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of the partition that have an n-gram, by language."""
    counts: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        langs = np.array(batch.column("lang").to_pylist(), object)
        data, offsets = as_bytes(batch.column("text"))
        for a, b in row_chunks(offsets, _CHUNK):
            part = data[offsets[a] : offsets[b]]
            for hashes, row in ngrams(part, offsets[a : b + 1] - offsets[a]):
                order = np.lexsort((hashes, row))
                hashes, row = hashes[order], row[order]
                new = np.append(True, (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1]))[: len(hashes)]
                hashes, lang = hashes[new], langs[a:b][row[new]]
                for one in set(lang.tolist()):
                    old = counts.get(one, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
                    grams, where = np.unique(np.concatenate([old[0], hashes[lang == one]]), return_inverse=True)
                    n = np.bincount(where, np.concatenate([old[1], np.ones(int((lang == one).sum()))]), len(grams))
                    counts[one] = grams, n.astype(np.int64)
    for one, (grams, n) in counts.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([one] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"]
        )


def fit(docs: DataFrame, learn_from: Column, bound: int = FIT_ROWS) -> LanguageFilters:
    """Filters from the text and lang of ``docs`` rows that ``learn_from`` (over doc_id) admits.

    Rows without a language or text are left out. Only n-grams that a fixed share of a language's documents has are
    sent to the driver, so their number is bounded by the n-grams of a document over that share.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & learn_from)
    rows = bounded_classes(rows, "doc_id", "lang", bound)
    documents = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(documents)
    if not languages:
        return build([], np.zeros(0, np.uint64), np.zeros((0, 1), np.uint8))
    counted = shipped(rows.select("lang", "text")).mapInArrow(lean(_document_counts), "lang string, gram long, n long")
    sizes = F.create_map(*(F.lit(x) for pair in documents.items() for x in pair))
    rates = counted.groupBy("lang", "gram").agg((F.sum("n") / F.element_at(sizes, F.col("lang"))).alias("rate"))
    chosen = (
        rates.where(F.col("rate") >= LEAST_RATE)
        .groupBy("gram")
        .agg(F.collect_list(F.struct("lang", "rate")).alias("of"))
        .select("gram", F.expr(f"transform(filter(of, x -> x.rate >= {LEAST_SHARE} * array_max(of.rate)), x -> x.lang)").alias("langs"))
        .toArrow()
    )
    bit = {lang: i for i, lang in enumerate(languages)}
    bits = np.zeros((chosen.num_rows, -(-len(languages) // 8) * 8), np.uint8)
    for i, langs in enumerate(chosen.column("langs").to_pylist()):
        bits[i, [bit[x] for x in langs]] = 1
    return build(languages, chosen.column("gram").to_numpy().view(np.uint64), np.packbits(bits, axis=1, bitorder="little"))


def language(docs: DataFrame, model: LanguageFilters) -> DataFrame:
    """(doc_id, lang_pred, score) for every row of ``docs`` (doc_id, text), whole texts.

    A null text or one without a letter is ``und`` with score 0, as is every text if no language was learnt. A text
    none of whose n-grams is known gets the first language with score 0. Ties go to the language first in order.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        n_languages = len(model.languages)
        names = np.array([*model.languages, UNKNOWN], object)
        for batch in batches:
            data, offsets = as_bytes(batch.column("text"))
            best, share = np.full(batch.num_rows, n_languages), np.zeros(batch.num_rows)
            for a, b in row_chunks(offsets, _CHUNK) if n_languages else ():
                part, borders = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                counts, total = np.zeros((b - a, n_languages)), np.zeros(b - a)
                for hashes, row in ngrams(part, borders):
                    ends = np.searchsorted(row, np.arange(b - a + 1))
                    total += np.diff(ends)
                    masks = model.masks(hashes)
                    for lang in range(n_languages):
                        sums = np.concatenate([[0], np.cumsum(masks[:, lang >> 3] >> (lang & 7) & 1, dtype=np.int64)])
                        counts[:, lang] += sums[ends[1:]] - sums[ends[:-1]]
                wrong = model.false_positive
                true = np.maximum(0.0, (counts - total[:, None] * wrong) / np.maximum(1e-9, 1 - wrong))
                best[a:b] = true.argmax(axis=1)
                share[a:b] = true.max(axis=1) / np.maximum(true.sum(axis=1), 1e-9)
                ascii_letters = np.concatenate([[0], np.cumsum(LETTER[part] & (part < 0x80))])[borders]
                for row in np.flatnonzero(np.diff(ascii_letters) == 0):
                    text = part[borders[row] : borders[row + 1]].tobytes().decode("utf-8", "replace")
                    if not any(map(str.isalpha, text)):
                        best[a + row], share[a + row] = n_languages, 0.0
            columns = [batch.column("doc_id"), pa.array(names[best].tolist(), pa.string()), pa.array(np.clip(share, 0, 1))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    rows = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double"
    return shipped(rows).mapInArrow(lean(run), schema)
