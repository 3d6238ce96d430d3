"""Quality classifier: logistic regression over hashed word n-grams, trained with follow-the-regularised-leader updates.

Tokens are runs of letters and runs of symbols with their case; a repeated token is a back-reference. Scoring is one
pass of sparse dot products without a shuffle over whole texts.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, functions as F

from martwright.llm.features import counted_ngrams
from martwright.llm.linear import Ftrl, LinearModel, score, train
from martwright.llm.ship import shipped
from martwright.llm.toxicity import labelled

#: Labelled rows that a model is fitted on at most (about: they are chosen by a hash of the id).
FIT_ROWS = 12_000
PARAMETERS = Ftrl(bits=20, alpha=1.0, l1=0.3, rounds=10, min_rows=2)


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column, bound: int = FIT_ROWS, p: Ftrl = PARAMETERS) -> LinearModel:
    """``learn_from`` is a condition on ``doc_id``; ``labels`` has doc_id and quality."""
    return train(labelled(docs, labels, "quality", learn_from, bound), partial(counted_ngrams, bits=p.bits), p)


def quality(docs: DataFrame, model: LinearModel) -> DataFrame:
    """(doc_id, score) for each row of ``docs`` (doc_id, text), with a score in (0, 1).

    A null text scores as an empty one, by the bias alone. Repeated rows and null ids stay, other columns are dropped.
    """
    return shipped(docs).select("doc_id", _probability(model).alias("score"))


def accepted(docs: DataFrame, model: LinearModel, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (text and any others) that score at least ``least``, with all their columns."""
    return shipped(docs).where(_probability(model) >= least)


def _probability(model: LinearModel) -> Column:
    return score(F.col("text"), model, partial(counted_ngrams, bits=model.bits))
