"""Toxicity: FTRL-proximal logistic regression over hashed words, word pairs and skip-grams.

Per-coordinate rates let rare but telling words learn fast; the L1 term leaves a few hundred weights, which travel with
the scoring function. Scoring is one pass without a shuffle over whole texts.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from martwright.llm.features import present_ngrams
from martwright.llm.linear import Ftrl, LinearModel, hash_fraction, score, train
from martwright.llm.ship import shipped

#: Labelled rows that a model is fitted on at most (about: they are chosen by a hash of the id).
FIT_ROWS = 12_000
PARAMETERS = Ftrl(bits=22, alpha=8.0, l1=4.0, rounds=12, min_rows=5)


#: Bytes of text in that sample at most (about).
FIT_BYTES = 192 << 20
#: Share of the sample that a rare label gets at least, if it has so many rows.
LEAST_OF_LABEL = 1 / 8


def labelled(docs: DataFrame, labels: DataFrame, label: str, learn_from: Column, bound: int) -> DataFrame:
    """(key, text, label) of at most about ``bound`` labelled documents that ``learn_from`` (over doc_id) admits.

    A document with several label rows is used once, with its largest label; labels other than 0 and 1 and rows with a
    null id are left out. A label of few documents is drawn more often, up to ``LEAST_OF_LABEL``. Documents of one id with
    the same text count once, and what the drawn ids have in the table is bounded again, by rows and by bytes.
    """
    wanted = (
        labels.select("doc_id", F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & learn_from)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    counts = {r["label"]: r["n"] for r in wanted.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    shares = {name: max(min(1.0, bound / total), min(1.0, LEAST_OF_LABEL * bound / n)) for name, n in counts.items()}
    if any(share < 1 for share in shares.values()):
        rate = F.create_map(*(F.lit(x) for pair in shares.items() for x in pair))
        wanted = wanted.where(hash_fraction(F.col("doc_id")) < F.element_at(rate, F.col("label")))
    # ``wanted`` has no more than about ``bound`` rows of an id and a number, so the documents need not be shuffled
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    met = F.broadcast(wanted).join(docs.select("doc_id", text.alias("text")), "doc_id")
    met = met.select(F.col("doc_id").alias("key"), "text", "label")
    kept = bounded_rows(met.withColumn("digest", F.xxhash64("key", "text")), 2 * bound, FIT_BYTES)
    return kept.dropDuplicates(["key", "text"]).select("key", "text", "label")


def bounded_rows(rows: DataFrame, most: int, most_bytes: int) -> DataFrame:
    """About ``most`` of the rows and ``most_bytes`` of their texts, chosen by ``digest``, or all if there are no more.

    Equal digests count once. All but the digests and sizes stays in the tasks that read it.
    """
    sizes = rows.select("digest", F.octet_length("text").alias("size")).groupBy("digest").agg(F.max("size").alias("size"))
    n, size = sizes.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    share = min(1.0, most / max(n, 1), most_bytes / max(size, 1))
    return rows if share == 1 else rows.where(F.pmod("digest", F.lit(1 << 30)) < int(share * (1 << 30)))


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column, bound: int = FIT_ROWS, p: Ftrl = PARAMETERS) -> LinearModel:
    """``learn_from`` is a condition on ``doc_id``; ``labels`` has doc_id and toxic."""
    return train(labelled(docs, labels, "toxic", learn_from, bound), partial(present_ngrams, bits=p.bits), p)


def toxicity(docs: DataFrame, model: LinearModel) -> DataFrame:
    """(doc_id, score) for each row of ``docs`` (doc_id, text), with a score in (0, 1).

    A null text scores as an empty one, by the bias alone. Repeated rows and null ids stay, other columns are dropped.
    """
    probability = score(F.col("text"), model, partial(present_ngrams, bits=model.bits))
    return shipped(docs).select("doc_id", probability.alias("score"))
