import itertools
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from llm_helpers import equal_hashes
from pyspark.sql import functions as F

from martwright.llm import quality_rules, queries
from martwright.llm.quality_rules import FEATURES, LineField, fit_lines, measure, viterbi
from martwright.llm.text import run_codes

SF = "/root/testdata/sf0.01"
TEXTS = ["a b c a b c", "", None, " \n\t\n", "x\nx\n\nx \nx", "#é|日\n$ 1", "w " * 200, "a b a b a", "one\ntwo\none\ntwo\n"]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, duplicates = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            duplicates += line in seen
            seen.add(line)
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts, covered = Counter(triples), set()
    for i, t in enumerate(triples):
        if counts[t] > 1:
            covered |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(covered)


def test_measures():
    found = []
    for m in measure(pa.array(TEXTS)):
        found += list(zip(m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, strict=True))
    assert [tuple(map(int, x)) for x in found] == [plain(t) for t in TEXTS]


def test_words_and_lines_with_equal_hashes_are_told_apart():
    left, right = equal_hashes()
    texts = [f"{left}\n{right}\n{left}", f"a {left} b a {right} b", f"a {left} b a {left} b"]
    found = [(int(d), int(r)) for m in measure(pa.array(texts)) for d, r in zip(m.n_dup_lines, m.n_repeat_words, strict=True)]
    assert found == [(1, 0), (0, 0), (0, 6)] == [plain(t)[3:] for t in texts]


def test_run_codes():
    rng = np.random.default_rng(2)
    for most in (3, 1 << 40):
        numbers = rng.integers(0, 3, 200) * (most // 3)
        found = run_codes(numbers, 3)
        runs = [tuple(numbers[i : i + 3]) for i in range(198)]
        assert [[a == b for b in found] for a in found] == [[a == b for b in runs] for a in runs]
    assert len(run_codes(numbers[:2], 3)) == 0 and len(run_codes(numbers[:0], 3)) == 0


def test_whole_documents_and_clean_ones_stay(spark):
    found = {r["doc_id"]: r for r in queries.op8_quality_rules(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    for i, text in docs:
        r, wanted = found[i], plain(text)
        assert tuple(r[1:6]) == wanted
        assert r["base_failed"] == (wanted[0] < 50 or 100 * wanted[4] > 50 * wanted[0])
        assert not (r["base_failed"] and r["kept"])
    labels = dict(spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").collect())
    passed = [(labels[i], r["kept"]) for i, r in found.items() if i in labels and not r["base_failed"]]
    assert all(kept for quality, kept in passed if quality)
    assert sum(not kept for quality, kept in passed if not quality) >= 0.9 * sum(not quality for quality, _ in passed)


def random_field(seed):
    rng = np.random.default_rng(seed)
    model = LineField(rng.normal(size=FEATURES), rng.normal(size=2), rng.normal(size=(2, 2)))
    lengths = [1, 4, 2, 0, 5, 3]
    row = np.repeat(np.arange(6), lengths)
    features = rng.integers(0, FEATURES, (len(row), 9))
    return model, features, row


def score(model, features, labels):
    total = model.start[labels[0]] + sum(model.transition[a, b] for a, b in zip(labels[:-1], labels[1:], strict=True))
    return total + sum(model.feature[f].sum() for f, x in zip(features, labels, strict=True) if x)


def test_viterbi_is_the_best_of_all_sequences():
    for seed in range(5):
        model, features, row = random_field(seed)
        label = viterbi(model, features, row)
        for r in set(row.tolist()):
            own = features[row == r]
            best = max(itertools.product((0, 1), repeat=len(own)), key=lambda x: score(model, own, x))
            assert tuple(label[row == r]) == best


def test_gradient_is_that_of_the_likelihood():
    model, features, row = random_field(9)
    label = np.random.default_rng(1).integers(0, 2, len(row))

    def likelihood(m):
        total = 0.0
        for r in set(row.tolist()):
            own, x = features[row == r], tuple(label[row == r])
            every = [score(m, own, y) for y in itertools.product((0, 1), repeat=len(own))]
            total += score(m, own, x) - np.log(np.exp(every).sum())
        return total

    feature, start, transition = quality_rules._gradient(model, features, row, label)
    step = 1e-5
    for array, found in ((model.feature, feature), (model.start, start), (model.transition, transition)):
        for at in np.ndindex(array.shape):
            old = array[at]
            array[at] = old + step
            high = likelihood(model)
            array[at] = old - step
            low = likelihood(model)
            array[at] = old
            assert abs((high - low) / (2 * step) - found[at]) < 1e-5


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b\n" * 40), (2, "\n"), (None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(2, 1)], "doc_id long, quality int")
    model = quality_rules.fit(docs, labels)
    assert not model.feature.any()
    found = quality_rules.quality_rules(docs, model).select("doc_id", "n_words", "content_share", "kept")
    assert sorted(map(tuple, found.collect()), key=repr) == [(1, 80, 1.0, False), (2, 0, 0.0, False), (None, 0, 0.0, False)]
    assert fit_lines(np.zeros((0, 9), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)).start.tolist() == [0, 0]
    assert quality_rules.quality_rules(docs.limit(0), model).where(F.lit(True)).collect() == []
