"""NN-descent against a comparison of all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from martwright.llm import nn_descent

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, threshold=0.93):
    """(vec_id, n_links, component_id, kept) by comparing all pairs of (vec_id, embedding, label)."""

    def good(vector):
        return bool(vector) and all(x is not None and np.isfinite(x) for x in vector) and any(vector)

    n = len(rows)
    linked = [set() for _ in rows]
    units = [np.float64(np.float32(v)) if good(v) else None for _, v, _ in rows]
    units = [u / np.sqrt((u * u).sum()) if u is not None else None for u in units]
    for i in range(n):
        for j in range(i):
            if units[i] is None or units[j] is None or rows[i][2] is None or rows[i][2] != rows[j][2]:
                continue
            if len(units[i]) == len(units[j]) and float(units[i] @ units[j]) >= threshold:
                linked[i].add(j)
                linked[j].add(i)
    root = list(range(n))
    for start in range(n):
        if root[start] == start:
            waiting = [start]
            while waiting:
                i = waiting.pop()
                root[i] = start
                waiting += [j for j in linked[i] if root[j] != start]
    smallest = {}
    for i in range(n):
        if rows[i][0] is not None:
            smallest[root[i]] = min(smallest.get(root[i], rows[i][0]), rows[i][0])
    found = [(rows[i][0], len(linked[i]), smallest.get(root[i])) for i in range(n)]
    return sorted(((*f, f[0] == f[2]) for f in found), key=repr)


def found(spark, rows, **options):
    frame = spark.createDataFrame([(i, v, label) for i, v, label in rows], SCHEMA).repartition(4)
    result = nn_descent.near_duplicates(frame, **options)
    assert result.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in result.collect()), key=repr)


def near(rng, vector, noise):
    return (vector + rng.normal(size=len(vector)) * noise * np.linalg.norm(vector) / np.sqrt(len(vector))).tolist()


def test_pairs_groups_and_copies(spark):
    rng = np.random.default_rng(3)
    vectors = [rng.normal(size=24) for _ in range(700)]
    rows = [v.tolist() for v in vectors]
    rows += [near(rng, vectors[i], 0.1) for i in range(40)]  # pairs
    rows += [near(rng, vectors[50], 0.15) for _ in range(60)]  # a group beyond any list
    rows += [near(rng, vectors[60], 0.3) for _ in range(50)]  # one whose points are linked only in part
    rows += [rows[710]] * 30 + [vectors[50].tolist()] * 5 + [vectors[99].tolist()]  # exact copies
    rows += [(np.array(rows[4]) * 7).tolist()]  # another length, the same direction
    ids = rng.permutation(len(rows)).tolist()
    labelled = [(i, v, 1 if k < 650 or k > 700 else 2) for k, (i, v) in enumerate(zip(ids, rows, strict=True))]
    assert found(spark, labelled) == plain(labelled)


def test_short_lists_lose_no_link(spark):
    """Two groups of 40 whose closest points are linked, far below the nearest places of any list."""
    rng = np.random.default_rng(8)
    base, other = rng.normal(size=16), rng.normal(size=16)
    base /= np.linalg.norm(base)
    other -= base * (other @ base)
    other /= np.linalg.norm(other)
    angle = np.arccos(0.93) - 0.02
    second = np.cos(angle) * base + np.sin(angle) * other
    rows = [near(rng, base, 0.04) for _ in range(40)] + [near(rng, second, 0.04) for _ in range(40)]
    rows += [rng.normal(size=16).tolist() for _ in range(200)]
    labelled = [(i, v, 0) for i, v in enumerate(rows)]
    expected = plain(labelled)
    assert len({r[2] for r in expected[:80]}) < 80
    assert found(spark, labelled, neighbours=4, trees=2) == expected


def test_threshold_is_exact(spark):
    """Cosines on both sides of the threshold, closer to it than half precision can tell."""
    rows = []
    for k, step in enumerate((-1e-4, -1e-6, 1e-6, 1e-4)):
        cosine = 0.93 + step
        rows += [(2 * k, [1.0, 0.0], k), (2 * k + 1, [cosine, float(np.sqrt(1 - cosine**2))], k)]
    assert [r[1] for r in found(spark, rows)] == [0, 0, 0, 0, 1, 1, 1, 1]
    assert found(spark, rows) == plain(rows)


def test_awkward_rows(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 2.0, 3.0], 5),
        (1, [1.0, 2.0, 3.0], 5),
        (2, [1.0, 2.0, 3.0], None),
        (3, [1.0, 2.0, 3.0], 6),
        (4, None, 5),
        (5, [], 5),
        (6, [0.0, 0.0, 0.0], 5),
        (7, [0.0, 0.0, 0.0], 5),
        (8, [1.0, None, 3.0], 5),
        (9, [1.0, nan, 3.0], 5),
        (10, [1.0, inf, 3.0], 5),
        (10, [1.0, inf, 3.0], 5),
        (None, [1.0, 2.0, 3.1], 5),
        (None, [-1.0, 0.5, 0.0], 5),
        (None, None, None),
        (11, [1.0, 2.0], 5),
        (12, [1.0, 2.0], 5),
        (13, [1e30, 2e30, 3e30], 5),
        (14, [1e-30, 2e-30, 3e-30], 5),
        (15, [-0.0, 1.0, 0.0], 7),
        (16, [0.0, 1.0, -0.0], 7),
    ]
    expected = plain(rows)
    assert found(spark, rows) == expected
    assert (10, 0, 10, True) in expected and (1, 4, 1, True) in expected


def test_empty_and_clashing(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert nn_descent.near_duplicates(frame).collect() == []
    frame = spark.createDataFrame([(3, [1.0, 1.0], 1), (2, [1.0, 1.01], 1)], SCHEMA)
    frame = frame.withColumns({name: F.lit("x") for name in ("key", "vector", "copies", "cid", "root", "n_links", "half")})
    assert sorted(map(tuple, nn_descent.near_duplicates(frame).collect())) == [(2, 1, 2, True), (3, 1, 2, False)]


def test_double_precision_and_other_types(spark):
    rows = [("b", [1.0, 1e-9], "x"), ("a", [1.0, 2e-9], "x"), ("c", [1.0, 1.0], "x")]
    frame = spark.createDataFrame(rows, "vec_id string, embedding array<double>, label string")
    assert sorted(map(tuple, nn_descent.near_duplicates(frame).collect())) == [
        ("a", 1, "a", True), ("b", 1, "a", False), ("c", 0, "c", True)
    ]


@pytest.mark.parametrize("work", ["descent", "whole"])
def test_a_part_finds_what_it_should(spark, monkeypatch, work):
    """The descent alone finds pairs that no tree has in one block; counting alone is exact."""
    rng = np.random.default_rng(1)
    vectors = [rng.normal(size=12) for _ in range(2000)]
    rows = [v.tolist() for v in vectors] + [near(rng, v, 0.12) for v in vectors[:300]]
    points = spark.createDataFrame([(i, "x", v, 1) for i, v in enumerate(rows)], "cid long, label string, vector array<float>, copies long")
    units = nn_descent.unit(np.float32(rows).astype(np.float64))
    true = np.triu(units @ units.T >= 0.93, 1)
    if work == "descent":
        monkeypatch.setattr(nn_descent, "LEAF", 64)
        first = nn_descent.first_lists(points, None, [0, 1], 12).withColumn("born", F.lit(0))
        before = nn_descent.links_of(points, first, 0.93).count()
        graph = nn_descent.Graph(points, 0.93)
        graph.descend([0, 1], 12)
        graph.link()
        links = {tuple(r) for r in graph.links.collect()}
        assert all(true[a, b] for a, b in links) and before < 0.97 * true.sum()
        assert len(links) >= 0.99 * true.sum()
    else:
        home = points.select("cid", F.lit(7).cast("long").alias("root"))
        whole = points.select(F.lit(7).cast("long").alias("root")).distinct()
        monkeypatch.setattr(nn_descent, "BLOCK", 700)
        counts = {r["cid"]: r["n"] for r in nn_descent.counted(points, home, whole, 0.93).collect()}
        both = true | true.T
        assert [counts[i] for i in range(len(rows))] == both.sum(axis=1).tolist()
