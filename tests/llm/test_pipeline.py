"""The stages against plain versions, each on its own input."""

import pytest

import corpus_pipeline
from llm_helpers import SF, rows
from martwright.llm import queries
from martwright.llm.store import stored
from test_decontaminate import words
from test_simhash import plain_components, plain_fingerprint


@pytest.fixture(scope="module")
def outputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for _, stage in corpus_pipeline.STAGES:
        found.append(stored(stage(spark, found[-1], SF)))
    return found


def test_names_and_columns(outputs):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "pii", "byte_level_bpe"
    ]
    assert all(o.columns == outputs[0].columns for o in outputs[:-1])
    assert corpus_pipeline.ORACLE_SQL is None


def test_quality_keeps_what_the_operator_accepts(spark, outputs):
    accepted = queries.op10_quality_classifier(spark, SF).where("predicted = 1")
    assert rows(outputs[1].select("doc_id")) == rows(accepted.select("doc_id"))
    clean = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id")
    assert clean.join(outputs[1], "doc_id", "left_anti").count() == 0


def test_one_document_of_each_group_stays(outputs):
    docs = [(r["doc_id"], plain_fingerprint(r["text"])) for r in outputs[1].collect()]
    root = plain_components(sorted({f for _, f in docs}), 2)
    first = {}
    for i, f in docs:
        first[root[f]] = min(first.get(root[f], i), i)
    assert rows(outputs[2].select("doc_id")) == sorted([(i,) for i in first.values()], key=repr)


def test_contaminated_documents_go(spark, outputs):
    windows = set()
    for (text,) in spark.read.parquet(f"{SF}/benchmark.parquet").select("text").collect():
        w = words(text)
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9) if w else 0)}
    clean = []
    for r in outputs[2].collect():
        w = words(r["text"])
        if not any(tuple(w[i : i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1)):
            clean.append(r["doc_id"])
    assert rows(outputs[3].select("doc_id")) == sorted([(i,) for i in clean], key=repr)


def test_personal_data_is_gone_and_tokens_are_whole(outputs):
    from test_pii import plain

    texts = {r["doc_id"]: r["text"] for r in outputs[4].collect()}
    assert texts.keys() == {r["doc_id"] for r in outputs[3].collect()}
    assert not any(plain(t) for t in texts.values())
    tokens = {r["doc_id"]: r for r in outputs[5].collect()}
    assert tokens.keys() == texts.keys()
    import hashlib

    assert all(tokens[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest() for i, t in texts.items())


def test_run_is_the_stages_in_a_row(spark, outputs):
    assert rows(corpus_pipeline.run(spark, SF)) == rows(outputs[5])
