import pytest
from llm_helpers import rows
from pyspark.sql import functions as F

from martwright.llm import language_id, linear, queries
import numpy as np

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = queries.op3_language_id(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    judged = found.join(docs, "doc_id").where("held_out")
    assert judged.where(F.col("lang") == F.col("lang_pred")).count() >= 0.99 * judged.count()
    assert found.where("score < 0 or score > 1").count() == 0


@pytest.mark.parametrize("languages", [1, 4, 19])
def test_filters_hold_every_ngram_and_few_others(languages):
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    bits = rng.random((3000, languages)) < 0.3
    padded = np.zeros((3000, -(-languages // 8) * 8), np.uint8)
    padded[:, :languages] = bits
    model = language_id.build([str(i) for i in range(languages)], hashes, np.packbits(padded, axis=1, bitorder="little"))
    found = np.unpackbits(model.masks(hashes), axis=1, bitorder="little")[:, :languages].astype(bool)
    assert (found | ~bits).all()
    strangers = np.unpackbits(model.masks(rng.integers(0, 2**63, 20_000, dtype=np.uint64)), axis=1, bitorder="little")
    assert np.allclose(strangers[:, :languages].mean(axis=0), model.false_positive, atol=0.02)


def test_ngrams_do_not_cross_rows():
    def of(text):
        data = np.frombuffer(text, np.uint8)
        return sorted(h for hashes, _ in language_id.ngrams(data, np.array([0, len(data)])) for h in hashes.tolist())

    both = np.frombuffer(b"ab 1cDe" + b"xyz", np.uint8)
    first, second = [], []
    for hashes, row in language_id.ngrams(both, np.array([0, 7, 7, 10])):
        first += hashes[row == 0].tolist()
        second += hashes[row == 2].tolist()
        assert set(row.tolist()) <= {0, 2}
    assert sorted(first) == of(b"AB--cde") and sorted(second) == of(b"xyz")


def test_no_letters_or_nothing_learnt(spark):
    docs = spark.createDataFrame(
        [(1, "der die das und", "de"), (2, "the of and", "en"), (3, "12 !?  ", None), (4, None, None), (None, "日本", None)],
        "doc_id long, text string, lang string",
    )
    model = language_id.fit(docs, F.lit(True))
    found = {r[0]: r[1:] for r in language_id.language(docs, model).collect()}
    assert found[1][0] == "de" and found[2][0] == "en"
    assert found[3] == ("und", 0.0) and found[4] == ("und", 0.0) and found[None] == ("de", 0.0)
    nothing = language_id.fit(docs, F.lit(False))
    assert {r[1:] for r in language_id.language(docs, nothing).collect()} == {("und", 0.0)}
    assert rows(language_id.language(docs.limit(0), model)) == []


def test_a_rare_language_is_learnt(spark):
    docs = [(i, f"the houses of the town {i}", "en") for i in range(3000)] + [(-i, f"les maisons et les villes {i}", "fr") for i in range(1, 7)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = language_id.fit(frame, F.lit(True), bound=100)
    assert model.languages == ["en", "fr"]
    found = language_id.language(frame, model).where("doc_id < 0").collect()
    assert {r["lang_pred"] for r in found} == {"fr"}
    sampled = linear.bounded_classes(frame, "doc_id", "lang", 100).groupBy("lang").count().collect()
    counts = {r["lang"]: r["count"] for r in sampled}
    assert counts["fr"] == 6 and 60 <= counts["en"] <= 130


def test_even_shares_use_up_the_bound():
    counts = {"a": 10, "b": 1000, "c": 5, "d": 4000}
    shares = linear.even_shares(counts, 415)
    assert shares == {"a": 1.0, "c": 1.0, "b": 0.2, "d": 0.05}
