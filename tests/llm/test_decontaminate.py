import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import documents, equal_hashes, rows  # noqa: F401
from pyspark.sql import functions as F

from martwright.llm import decontaminate
from martwright.llm.decontaminate import contamination, positional_index

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def plain(docs, items, size):
    windows = {}
    for item, text in items:
        w = words(text)
        for p in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[p : p + size]), set()).add(item)
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for p in range(len(w) - n + 1):
                own = windows.get(tuple(w[p : p + n]))
                if own:
                    hit.update(range(p, p + n))
                    found |= own
        out.append((i, len(w), len(hit), sorted(found - {None})))
    return sorted(out, key=repr)


def result(spark, docs, items, size, **options):
    index = positional_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    found = contamination(index, spark.createDataFrame(items, "item_id long, text string"), size, **options)
    return rows(found.select("doc_id", "n_words", "n_hit", F.array_sort("items")))


def made(seed):
    rng = random.Random(seed)
    items = [(rng.choice([None, *range(20)]), " ".join(rng.choices("abcdef", k=rng.randint(0, 9)))) for _ in range(25)]
    docs = [(rng.choice([None, *range(40)]), rng.choice(["", None, " ".join(rng.choices("abcdefGH-", k=60))])) for _ in range(50)]
    return docs, [*items, (5, None), (6, "  ")]


@pytest.mark.parametrize("seed, size", [(1, 4), (2, 3), (3, 1)])
def test_random_phrases(spark, seed, size):
    docs, items = made(seed)
    assert result(spark, docs, items, size) == plain(docs, items, size)


def test_benchmark_in_blocks(spark, monkeypatch):
    docs, items = made(4)
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 60)
    assert result(spark, docs, items, 4) == plain(docs, items, 4)


def test_no_items_and_no_documents(spark):
    docs = [(1, "a b"), (None, None)]
    assert result(spark, docs, [], 10) == [(1, 2, 0, []), (None, 0, 0, [])]
    assert result(spark, [], [(1, "a")], 10) == []


def test_whole_documents_with_item_names(spark, documents):
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    assert result(spark, documents, items, 10) == plain(documents, items, 10)
    index = positional_index(spark.createDataFrame([(1, "a b c")], "doc_id long, text string"))
    named = spark.createDataFrame([("x", "B c"), ("y", "c b")], "item_id string, text string")
    assert contamination(index, named).select("items").first()[0] == ["x"]


def test_proximity(spark):
    docs = [(1, "the rare one comes far before that other thing"), (2, "thing rare other"), (3, "rare"), (4, "other x x x x thing rare")]
    index = positional_index(spark.createDataFrame(docs, "doc_id long, text string"))
    items = spark.createDataFrame([(9, "rare other thing")], "item_id long, text string")
    found = {r["doc_id"]: (r["items"], r["near_items"]) for r in contamination(index, items, within=5).collect()}
    assert found == {1: ([], []), 2: ([], [9]), 3: ([], []), 4: ([], [])}
    found = {r["doc_id"]: r["near_items"] for r in contamination(index, items, within=7).collect()}
    assert found == {1: [9], 2: [9], 3: [], 4: [9]}


def test_many_common_windows_are_matched_in_bounded_memory():
    words = ["a" if i % 2 else "b" for i in range(20_000)]
    docs = pa.RecordBatch.from_pydict({"doc_id": [1], "text": [" ".join(words)]})
    rng = random.Random(3)
    texts = [" ".join(rng.choices("ab", k=10)) for _ in range(1500)]
    windows = decontaminate.windows_of(texts, 10)
    segment = segment_of(docs, windows)
    tracemalloc.start()
    try:
        found, position = decontaminate.match(segment, windows)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    same = {p for p, w in enumerate(zip(*(words[i:] for i in range(10)))) if " ".join(w) in set(texts)}
    assert set(position.tolist()) == same
    assert len(set(found.tolist())) <= 2
    assert int(segment.counts.min()) * len(windows.terms) > 4 << 20
    assert peak < 200 << 20


def test_runs_of_positions_give_the_same_matches(monkeypatch):
    rng = random.Random(4)
    words = rng.choices("abc", k=400)
    windows = decontaminate.windows_of([" ".join(rng.choices("abc", k=3)) for _ in range(30)], 3)
    docs = pa.RecordBatch.from_pydict({"doc_id": [1], "text": [" ".join(words)]})
    segment = segment_of(docs, windows)
    for within in (None, 2):
        whole = decontaminate.match(segment, windows, within)
        monkeypatch.setattr(decontaminate, "FRONTIER", 7)
        parts = decontaminate.match(segment, windows, within)
        monkeypatch.undo()
        assert [x.tolist() for x in whole] == [x.tolist() for x in parts]


def segment_of(docs, windows):
    (words,) = decontaminate.words_of(docs.column("text"), decontaminate.ALPHANUMERIC)
    return decontaminate.open_segment(decontaminate.packed(words), windows.vocabulary)


def test_words_with_equal_hashes_are_told_apart(spark):
    left, right = equal_hashes()
    item = f"a question about the word {left} and four more words"
    docs = [(1, item.replace(left, right)), (2, item), (3, f"{item.upper()} {right}")]
    index = positional_index(spark.createDataFrame(docs, "doc_id long, text string"))
    found = contamination(index, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_hit"], r["items"]) for r in found} == {1: (0, []), 2: (10, [7]), 3: (10, [7])}


def test_repeated_items_are_looked_up_once(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "one two three four five six seven eight nine ten")], "doc_id long, text string")
    items = spark.createDataFrame([(i % 2, "two three four") for i in range(50)], "item_id long, text string")
    blocks = []
    plain = decontaminate.windows_of
    monkeypatch.setattr(decontaminate, "windows_of", lambda texts, size: blocks.append(len(texts)) or plain(texts, size))
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 28)
    found = decontaminate.contamination(decontaminate.positional_index(docs), items).collect()
    assert blocks == [2] and [(r["n_hit"], sorted(r["items"])) for r in found] == [(3, [0, 1])]
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 14)
    found = decontaminate.contamination(decontaminate.positional_index(docs), items).collect()
    assert sum(blocks[1:]) == 2 and [(r["n_hit"], sorted(r["items"])) for r in found] == [(3, [0, 1])]
