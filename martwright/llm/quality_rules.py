"""Quality rules: document measures and a linear-chain conditional random field over lines.

The field marks every line as content or boilerplate; Viterbi decoding finds the best sequence, and the share of the
words in content lines decides whether a document is kept. It is trained on lines of labelled documents, which take the
document's label: neighbouring lines and the features of a line tell what a single document's label cannot.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martwright.llm.linear import in_one_task
from martwright.llm.ship import lean, lean_group, shipped
from martwright.llm.text import NOT_SPACE, as_bytes, codes, ranges, row_chunks, run_codes, split_words
from martwright.llm.toxicity import labelled

#: Labelled documents that the field is fitted on at most (about: they are chosen by a hash of the id).
FIT_ROWS = 8_000
#: Share of a document's words that must stand in content lines.
LEAST_CONTENT = 0.5
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words

_STEPS = 150
_RATE = 0.5
_L2 = 1e-3

_BYTES = np.arange(256)
_SYMBOL = np.isin(_BYTES, [ord(c) for c in "#*$%&|<>"])
_UPPER = (_BYTES >= 0x41) & (_BYTES <= 0x5A)
_LOWER = ((_BYTES >= 0x61) & (_BYTES <= 0x7A)) | (_BYTES >= 0x80)
_DIGIT = (_BYTES >= 0x30) & (_BYTES <= 0x39)
_PUNCTUATION = (_BYTES > 0x20) & (_BYTES < 0x7F) & ~_UPPER & ~_LOWER & ~_DIGIT
_HEAD = (_BYTES & 0xC0) != 0x80
_STOP = np.isin(_BYTES, [ord(c) for c in ".!?:;"])

#: Upper bounds of the bins of each measure of a line; a line has one feature for each measure.
BINS = {
    "words": (3, 10, 25, 60),
    "symbols": (0.0, 0.03, 0.15),
    "upper": (0.05, 0.2, 0.6),
    "digits": (0.0, 0.1, 0.3),
    "punctuation": (0.05, 0.12, 0.25),
    "same_as_before": (0.0, 0.05, 0.3),
    "distinct": (0.3, 0.6, 0.85),
    "repeated_line": (0.5,),
    "stop_at_end": (0.5,),
}
_WIDTHS = [len(bounds) + 1 for bounds in BINS.values()]
FEATURES = sum(_WIDTHS)


@dataclass
class Measured:
    """Measures of some consecutive rows, and the features of their lines that have a word, in order."""

    first_row: int
    rows: int
    n_words: np.ndarray
    word_chars: np.ndarray
    n_symbols: np.ndarray
    n_dup_lines: np.ndarray
    n_repeat_words: np.ndarray
    line_row: np.ndarray
    line_words: np.ndarray
    features: np.ndarray  # lines x measures: places in the weights


def _sums(flags: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])


def _repeats(row: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether an equal (row, code) stands anywhere else, and whether it stands before."""
    order = np.lexsort((code, row))
    same = np.zeros(len(order), bool)
    same[1:] = (row[order][1:] == row[order][:-1]) & (code[order][1:] == code[order][:-1])
    before, anywhere = np.zeros(len(order), bool), np.zeros(len(order), bool)
    before[order] = same
    anywhere[order] = same | np.append(same[1:], False)[: len(order)]
    return anywhere, before


def measure(column: pa.Array) -> Iterator[Measured]:
    data, offsets = as_bytes(column)
    for a, b in row_chunks(offsets):
        part, borders = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        rows = b - a
        starts, ends, of_row = split_words(part, borders, NOT_SPACE)
        row = np.repeat(np.arange(rows), np.diff(of_row))
        code = codes(ranges(part, starts, ends))

        heads = _sums(_HEAD[part])
        chars = _sums(heads[ends] - heads[starts])
        symbols = _sums(_SYMBOL[part])
        triple = row[:-2] == row[2:] if len(row) > 2 else np.zeros(0, bool)
        windows = run_codes(code, 3)[triple]
        again, _ = _repeats(row[:-2][triple] if len(row) > 2 else row[:0], windows)
        first = np.flatnonzero(triple)[again]
        covered = np.zeros(len(row) + 2, bool)
        for i in range(3):
            covered[first + i] = True
        repeated = _sums(covered[: len(row)])

        line_borders = np.unique(np.concatenate([borders, np.flatnonzero(part == 10), np.flatnonzero(part == 10) + 1]))
        line_borders = line_borders[line_borders <= len(part)]
        line_start, line_end = line_borders[:-1], line_borders[1:]
        words_before = np.searchsorted(starts, line_borders)
        n = np.diff(words_before)
        some = n > 0
        line_start, line_end, n, first_word = line_start[some], line_end[some], n[some], words_before[:-1][some]
        line_row = np.searchsorted(borders, line_start, "right") - 1
        _, duplicate = _repeats(line_row, codes(ranges(part, line_start, line_end)))

        line_of_word = np.repeat(np.arange(len(n)), n)
        _, seen = _repeats(line_of_word, code)
        as_before = np.zeros(len(code), bool)
        as_before[1:] = (code[1:] == code[:-1]) & (line_of_word[1:] == line_of_word[:-1])
        last_word = first_word + n

        def share(flags: np.ndarray, start=line_start, end=line_end, part=part) -> np.ndarray:
            sums = _sums(flags[part])
            return (sums[end] - sums[start]) / np.maximum(1, end - start)

        letters = np.maximum(share(_UPPER | _LOWER), 1e-9)
        measures = {
            "words": n,
            "symbols": share(_SYMBOL),
            "upper": share(_UPPER) / letters,
            "digits": share(_DIGIT),
            "punctuation": share(_PUNCTUATION),
            "same_as_before": (_sums(as_before)[last_word] - _sums(as_before)[first_word]) / np.maximum(1, n),
            "distinct": 1 - (_sums(seen)[last_word] - _sums(seen)[first_word]) / np.maximum(1, n),
            "repeated_line": duplicate,
            "stop_at_end": _STOP[part[ends[last_word - 1] - 1]] if len(n) else np.zeros(0),
        }
        base, features = 0, []
        for width, (name, bounds) in zip(_WIDTHS, BINS.items(), strict=True):
            features.append(base + np.searchsorted(bounds, measures[name].astype(float)))
            base += width
        yield Measured(
            a,
            rows,
            np.diff(of_row),
            np.diff(chars[of_row]),
            np.diff(symbols[borders]),
            np.bincount(line_row, duplicate, rows).astype(np.int64),
            np.diff(repeated[of_row]),
            line_row,
            n,
            np.stack(features, axis=1) if features else np.zeros((0, len(BINS)), np.int64),
        )


@dataclass(frozen=True)
class LineField:
    """Weights of the features (for content; boilerplate is the zero point), of the first line and of transitions."""

    feature: np.ndarray = field(repr=False)
    start: np.ndarray
    transition: np.ndarray  # from, to; 0 boilerplate, 1 content


def _steps(row: np.ndarray) -> Iterator[np.ndarray]:
    """The first lines of all rows, then the second ones, and so on; rows with more lines stand first in each."""
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1])[: len(row)])
    length = np.diff(np.append(first, len(row)))
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    for t in range(int(length[0]) if len(length) else 0):
        yield first[: np.searchsorted(-length, -t, "left")] + t


def viterbi(model: LineField, features: np.ndarray, row: np.ndarray) -> np.ndarray:
    """The best labels of the lines of each row (1 content); at equal scores content."""
    content = model.feature[features].sum(axis=1)
    back = np.zeros((len(row), 2), np.int8)
    steps = list(_steps(row))
    last = np.zeros(len(row), np.int8)
    score = np.zeros((0, 2))
    for t, at in enumerate(steps):
        emit = np.stack([np.zeros(len(at)), content[at]], axis=1)
        if t == 0:
            score = model.start + emit
        else:
            ways = score[: len(at), :, None] + model.transition
            back[at] = np.where(ways[:, 1] >= ways[:, 0], 1, 0)
            score = np.concatenate([ways.max(axis=1) + emit, score[len(at) :]])
    final = np.where(score[:, 1] >= score[:, 0], 1, 0).astype(np.int8)
    label = last
    for t in range(len(steps) - 1, -1, -1):
        at = steps[t]
        longer = len(steps[t + 1]) if t + 1 < len(steps) else 0
        label[at[longer:]] = final[longer : len(at)]
        if longer:
            following = steps[t + 1]
            label[at[:longer]] = back[following, label[following]]
    return label


def _log_add(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _gradient(model: LineField, features: np.ndarray, row: np.ndarray, label: np.ndarray):
    """Observed minus expected counts of features, first labels and transitions, by forward and backward sums."""
    content = model.feature[features].sum(axis=1)
    emit = np.stack([np.zeros(len(row)), content], axis=1)
    steps = list(_steps(row))
    alpha, beta = np.zeros((len(row), 2)), np.zeros((len(row), 2))
    for t, at in enumerate(steps):
        alpha[at] = model.start + emit[at] if t == 0 else _log_add(alpha[at - 1][:, :, None] + model.transition, 1) + emit[at]
    transition = np.zeros((2, 2))
    for t in range(len(steps) - 1, 0, -1):
        at = steps[t]
        beta[at - 1] = _log_add(model.transition + (emit[at] + beta[at])[:, None, :], 2)
    total = _log_add(alpha + beta, 1)
    marginal = np.exp(alpha + beta - total[:, None])
    for at in steps[1:]:
        joint = alpha[at - 1][:, :, None] + model.transition + (emit[at] + beta[at])[:, None, :]
        transition -= np.exp(joint - total[at][:, None, None]).sum(axis=0)
        np.add.at(transition, (label[at - 1], label[at]), 1)
    error = label - marginal[:, 1]
    feature = np.bincount(features.ravel(), np.repeat(error, features.shape[1]), FEATURES)
    start = np.bincount(label[steps[0]], minlength=2) - marginal[steps[0]].sum(axis=0)
    return feature, start, transition


def fit_lines(features: np.ndarray, row: np.ndarray, label: np.ndarray) -> LineField:
    """Maximum likelihood with a small L2 term, by gradient steps with per-coordinate rates."""
    weights = np.zeros(FEATURES + 6)
    squares = np.full(len(weights), 1e-8)
    unpack = lambda w: LineField(w[:FEATURES], w[FEATURES : FEATURES + 2], w[FEATURES + 2 :].reshape(2, 2))
    for _ in range(_STEPS if len(row) else 0):
        feature, start, transition = _gradient(unpack(weights), features, row, label)
        gradient = np.concatenate([feature, start, transition.ravel()]) / len(row) - _L2 * weights
        squares += gradient**2
        weights = weights + _RATE * gradient / np.sqrt(squares)
    return unpack(weights)


def fit(docs: DataFrame, labels: DataFrame, learn_from: Column | None = None, bound: int = FIT_ROWS) -> LineField:
    """Weights from labelled documents (labels: doc_id, quality), fitted in one task on a bounded sample.

    Without any labelled line all weights are zero and every line counts as content.
    """
    rows = labelled(docs, labels, "quality", F.lit(True) if learn_from is None else learn_from, bound)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("label", "ascending"), ("text", "ascending")])
        labels = table.column("label").to_numpy()
        parts = list(measure(table.column("text")))
        row = np.concatenate([p.line_row + p.first_row for p in parts])
        model = fit_lines(np.concatenate([p.features for p in parts]), row, labels[row])
        weights = np.concatenate([model.feature, model.start, model.transition.ravel()])
        return pa.table({"lines": [len(row)], "weights": [weights.tolist()]})

    fitted = shipped(in_one_task(rows)).groupBy("task").applyInArrow(lean_group(run), "lines long, weights array<double>").collect()
    w = np.array(fitted[0]["weights"]) if fitted else np.zeros(FEATURES + 6)
    return LineField(w[:FEATURES], w[FEATURES : FEATURES + 2], w[FEATURES + 2 :].reshape(2, 2))


def quality_rules(docs: DataFrame, model: LineField) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): the measures, base_failed, content_share and kept.

    Whole texts; a null text has no words. A text without words has content share 0 and fails the base rules. Repeated
    rows and null ids stay, other columns are dropped.
    """
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for m in measure(batch.column("text")):
                label = viterbi(model, m.features, m.line_row)
                content = np.bincount(m.line_row, m.line_words * label, m.rows)
                columns = [batch.column("doc_id").slice(m.first_row, m.rows)]
                columns += [pa.array(getattr(m, name).astype(np.int64)) for name in counts]
                columns.append(pa.array(content / np.maximum(1, m.n_words)))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *counts, "content_share"])

    rows = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {', '.join(f'{c} long' for c in counts)}, content_share double"
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return (
        shipped(rows)
        .mapInArrow(lean(run), schema)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("content_share") >= LEAST_CONTENT))
    )
