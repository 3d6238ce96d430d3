"""Logistic regression over hashed features, trained with FTRL-proximal updates in Spark.

A featurizer turns the texts of an Arrow column into sparse rows. One task runs the per-coordinate updates over a sample
of rows and bytes that the caller has bounded, a few times; averaging the states of several tasks was measured to be
worse. A coordinate is admitted only if enough rows of the sample have it, so a row's own rare words cannot take the
blame for its label. Only the state reaches the driver, at most ``2**bits`` coordinates. Most weights end as exact zeros
by the L1 term; the others are sent out with the scoring function, which looks at no other features.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from martwright.llm.ship import give_back, lean_group, shipped

#: (column, known=None) -> for chunks of rows: first row, rows, row of each feature, its index, its value. ``known`` is
#: true at the indexes that are wanted; without it all are.
Featurizer = Callable[..., Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]]


@dataclass(frozen=True)
class Ftrl:
    """``alpha`` and ``beta`` set the per-coordinate rates alpha / (beta + sqrt(sum of squared gradients))."""

    bits: int = 22
    alpha: float = 4.0
    beta: float = 1.0
    l1: float = 2.0
    l2: float = 0.0
    rounds: int = 6
    min_rows: int = 4


@dataclass(frozen=True)
class LinearModel:
    """The weights that are not zero, and the bias."""

    bits: int
    index: np.ndarray = field(repr=False)
    weight: np.ndarray = field(repr=False)
    bias: float = 0.0

    def dense(self) -> np.ndarray:
        table = np.zeros(1 << self.bits, np.float64)
        table[self.index] = self.weight
        return table


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0)))


def weights(z: np.ndarray, n: np.ndarray, p: Ftrl) -> np.ndarray:
    """The closed-form minimiser: zero where the summed gradients stay within the L1 term."""
    return np.where(np.abs(z) <= p.l1, 0.0, -(z - np.sign(z) * p.l1) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2))


def update(z: np.ndarray, n: np.ndarray, index: np.ndarray, value: np.ndarray, label: int, p: Ftrl) -> None:
    """One FTRL-proximal step on a row, whose values may be one for all; the last coordinate is the bias, without L1 term."""
    zi, ni = z[index], n[index]
    w = weights(zi, ni, p)
    bias = -z[-1] / ((p.beta + np.sqrt(n[-1])) / p.alpha)
    error = float(sigmoid((w * value).sum() + bias)) - label
    gradient = error * value
    root = np.sqrt(ni + gradient * gradient)
    z[index] = zi + gradient - (root - np.sqrt(ni)) / p.alpha * w
    n[index] = ni + gradient * gradient
    root = np.sqrt(n[-1] + error * error)
    z[-1] += error - (root - np.sqrt(n[-1])) / p.alpha * bias
    n[-1] += error * error


def hash_fraction(key: Column) -> Column:
    """A number in [0, 1) that depends on the key alone."""
    return F.pmod(F.xxhash64(key), F.lit(1 << 30)) / F.lit(float(1 << 30))


def even_shares(counts: dict, bound: int) -> dict:
    """Of each class the share of its rows so that about ``bound`` are left: as many of each, or all of a smaller one."""
    shares, left = {}, bound
    for i, (name, n) in enumerate(sorted(counts.items(), key=lambda x: x[1])):
        quota = min(n, max(1, left // (len(counts) - i)))
        shares[name] = quota / n
        left -= quota
    return shares


def bounded_classes(rows: DataFrame, key: str, label: str, bound: int) -> DataFrame:
    """About ``bound`` of the rows, about as many of each value of ``label``, chosen by a hash of the key, or all rows."""
    counts = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count("*").alias("n")).collect()}
    if sum(counts.values()) <= bound:
        return rows
    shares = F.create_map(*(F.lit(x) for pair in even_shares(counts, bound).items() for x in pair))
    return rows.where(hash_fraction(F.col(key)) < F.element_at(shares, F.col(label)))


def in_one_task(rows: DataFrame) -> DataFrame:
    """Rows (key, text, label) as one group: the caller has bounded their number and bytes."""
    return rows.select(
        F.lit(0).alias("task"),
        F.xxhash64("key").alias("key"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.col("label").cast("int").alias("label"),
    )


def _fit(featurize: Featurizer, p: Ftrl):
    """FTRL over the rows, in an order that depends on the keys alone."""

    def fit(table: pa.Table) -> pa.Table:
        order = pc.sort_indices(table, [("key", "ascending"), ("label", "ascending"), ("text", "ascending")]).to_pylist()
        labels = table.column("label").to_numpy()
        seen = np.zeros(1 << p.bits, np.int32)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        one = np.ones(1)
        for _, count, row, index, value in featurize(table.column("text")):
            ends = np.searchsorted(row, np.arange(count + 1))
            np.add.at(seen, index, 1)
            plain = bool((value == 1).all())
            found += [
                (index[a:b].astype(np.int32), one if plain else value[a:b].astype(np.float32))
                for a, b in zip(ends[:-1], ends[1:], strict=True)
            ]
        admitted = np.flatnonzero(seen >= p.min_rows)
        place = np.full(1 << p.bits, -1, np.int32)
        place[admitted] = np.arange(len(admitted), dtype=np.int32)
        z, n = np.zeros(len(admitted) + 1), np.zeros(len(admitted) + 1)
        for i, (index, value) in enumerate(found):
            at = place[index]
            found[i] = at[at >= 0], value if value is one else value[at >= 0]
        for _ in range(p.rounds):
            for i in order:
                update(z, n, *found[i], int(labels[i]), p)
        state = [x.tobytes() for x in (admitted.astype(np.int32), z, n)]
        return pa.table({"rows": [len(labels)], **{k: [v] for k, v in zip(("index", "z", "n"), state, strict=True)}})

    return fit


def train(rows: DataFrame, featurize: Featurizer, p: Ftrl) -> LinearModel:
    """Fits ``rows`` (key, text, label 0 or 1), whose number and bytes the caller has bounded. Without rows, scores are 0.5."""
    fitted = (
        shipped(in_one_task(rows))
        .groupBy("task")
        .applyInArrow(lean_group(_fit(featurize, p)), "rows long, index binary, z binary, n binary")
    ).collect()
    if not fitted:
        return LinearModel(p.bits, np.zeros(0, np.int32), np.zeros(0))
    index = np.frombuffer(fitted[0]["index"], np.int32)
    z, n = np.frombuffer(fitted[0]["z"]), np.frombuffer(fitted[0]["n"])
    w = weights(z[:-1], n[:-1], p)
    some = np.flatnonzero(w)
    return LinearModel(p.bits, index[some], w[some], float(-z[-1] / ((p.beta + np.sqrt(n[-1])) / p.alpha)))


def score(text: Column, model: LinearModel, featurize: Featurizer) -> Column:
    """Probability of label 1: sparse dot products over batches of the text alone, whatever else a row has.

    The functions of this package must have been shipped to the session's workers.
    """

    @F.arrow_udf("double")
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        table = model.dense()
        known = table != 0
        for batch in texts:
            sums = np.full(len(batch), model.bias)
            for first, count, row, index, value in featurize(batch, known=known):
                sums[first : first + count] += np.bincount(row, table[index] * value, minlength=count)
            yield pa.array(sigmoid(sums))
        give_back()

    return run(text.cast("string"))
