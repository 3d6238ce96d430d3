import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from llm_helpers import documents  # noqa: F401

from martwright.llm import bpe, queries

SF = "/root/testdata/sf0.001"
TEXTS = ["", None, "a", " x\n\n  y", "日本語 🙂🙂", "\x00\x01", " " * 3000, "ab" * 2000, "don't  we'll 1234 ###!!", "ééé​", "<|endoftext|>"]


@pytest.fixture(scope="module")
def tokenizer():
    return queries.public_tokenizer()


@pytest.fixture(scope="module")
def reference(tokenizer):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tokenizer.ranks, special_tokens={}
    )


def test_texts_and_whole_documents(spark, tokenizer, reference, documents):
    docs = [(100_000 + i, t) for i, t in enumerate(TEXTS)] + documents
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r for r in bpe.decode(bpe.encode(frame, tokenizer), tokenizer).collect()}
    for i, text in docs:
        ids = reference.encode_ordinary(text or "")
        assert np.frombuffer(found[i]["ids"], "<u4").tolist() == ids and found[i]["n_tokens"] == len(ids)
        assert bytes(found[i]["decoded"]) == (text or "").encode()


def test_query_digests(spark, reference, documents):
    found = {r["doc_id"]: r for r in queries.op9_bpe(spark, SF).collect()}
    for i, text in documents:
        raw = np.array(reference.encode_ordinary(text or ""), "<u4").tobytes()
        assert found[i]["ids_sha256"] == hashlib.sha256(raw).hexdigest()
        assert found[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_perfect_hash_is_minimal_and_exact(tokenizer):
    hashed = tokenizer.hashed
    assert len(hashed.tokens) == len(set(hashed.tokens)) == len(tokenizer.ranks)
    assert all(hashed.get(t) == r for t, r in tokenizer.ranks.items())
    assert [hashed.get(x) for x in (b"", b"qzqzqz", b"\xff\xfe\xfd")] == [None, None, None]


def test_merge_takes_the_lowest_rank_first_and_the_leftmost():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 300, b"bc": 299, b"aa": 301, b"aab": 302, b"bcbc": 303}
    assert bpe.merge(b"abc", ranks) == [97, 299]
    assert bpe.merge(b"aaa", ranks) == [301, 97]
    assert bpe.merge(b"aaab", ranks) == [301, 300]
    assert bpe.merge(b"bcbcbc", ranks) == [303, 299]
    assert bpe.merge(b"", ranks) == [] and bpe.merge(b"z", ranks) == [122]


def test_unfit_vocabularies_are_refused(tmp_path, monkeypatch):
    path = tmp_path / "ranks"
    path.write_text("YQ== 0\n")
    with pytest.raises(ValueError, match="bytes without a token"):
        bpe.read_ranks(str(path))
    monkeypatch.setattr(bpe, "MOST_TOKENS", 10)
    with pytest.raises(ValueError, match="at most 10"):
        bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def test_memo_is_bounded(tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 5)
    codec = bpe.Codec(tokenizer.ranks, tokenizer.pattern, tokenizer.hashed)
    text = " ".join(f"zq{i}xk" for i in range(50)) + " " + "q" * 500
    ids = np.frombuffer(codec.encode(text), "<u4")
    tokens = {rank: token for token, rank in tokenizer.ranks.items()}
    assert b"".join(tokens[i] for i in ids.tolist()) == text.encode() and len(codec.memo) <= 5


@pytest.mark.parametrize("run", [1, 5, 1 << 18])
def test_long_texts_in_runs(spark, tokenizer, reference, monkeypatch, run):
    monkeypatch.setattr(bpe, "LONG", run)
    codec = bpe.Codec(tokenizer.ranks, tokenizer.pattern, tokenizer.hashed)
    for text in TEXTS:
        assert np.frombuffer(codec.encode(text or ""), "<u4").tolist() == reference.encode_ordinary(text or "")


def test_a_text_of_many_megabytes(spark, tokenizer, reference):
    text = "The 1,234 quick brown foxes don't jump; été, 日本語.\n" * 160_000
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    (found,) = bpe.decode(bpe.encode(frame, tokenizer), tokenizer).collect()
    assert len(text.encode()) > 8e6 and bytes(found["decoded"]) == text.encode()
    once = reference.encode_ordinary(text[: text.index("\n") + 1] * 3)
    assert found["n_tokens"] == len(once) // 3 * 160_000


def test_the_memos_are_bounded_and_change_nothing(tokenizer, reference, documents, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 50)
    codec = bpe.Codec(tokenizer.ranks, tokenizer.pattern, tokenizer.hashed)
    for _, text in documents[:60]:
        assert np.frombuffer(codec.encode(text or ""), "<u4").tolist() == reference.encode_ordinary(text or "")
        assert len(codec.memo) <= 50 and len(codec.older) <= 50
    codec.memo, codec.older = {"new": b"1234"}, {"old": b"5678"}
    assert codec.encode("old") == b"5678" and "old" in codec.memo
