"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martwright.llm.store import stored


def _with_smallest(edges: DataFrame) -> DataFrame:
    """Edges u, v with the smallest of u and all its neighbours; the join can be split where a node has very many."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(smallest, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point to the smaller node here."""
    linked = _with_smallest(edges)
    others = linked.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(linked.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of ``edges`` (u, v) but the roots, with the smallest node that it can reach.

    Loops and repeated edges do no harm; without edges the result is empty. Each round is written to the shared folder.
    """
    current = stored(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    state = None
    while True:
        now = current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
        current = stored(_small_star(_large_star(current)))
