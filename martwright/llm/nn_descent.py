"""Near-duplicate vectors by NN-descent: a neighbour graph refined through neighbours of neighbours.

Exact copies are one point with a weight. Every point starts with the nearest of its blocks in some random projection
trees (rows sorted by the signs of random projections and cut into blocks of one label). A round joins, at every point, its
neighbours with the points whose neighbour it is: any two of them that are closer than what they know become neighbours.
Rounds go on while they find new links, i.e. pairs at the threshold or above.

A list is saturated if all its places are links: more links may lie beyond it. It is enlarged to its whole component of
links, in two parts. Within the component all pairs are compared, block by block, and only counts leave a task. Outside of
it, the descent is repeated with lists that hold no points of the own component, until no more components meet. So a
list's length bounds no point's links. At the end a bounded set of points is compared with all points; if too few of
their links are known, the lists are doubled and the descent goes on with new trees.

Rounds send vectors in half precision; every pair near the threshold is compared again in double precision.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from martwright.llm.components import components
from martwright.llm.ship import lean, shipped
from martwright.llm.store import stored

#: Places in a neighbour list at first, and projection trees. A tree's blocks are islands, so there must be two at least for
#: a neighbour's neighbour to lie beyond.
NEIGHBOURS = 12
TREES = 4
#: Rows of a block of a tree.
LEAF = 256
#: Neighbours that are joined at a time; a point with more is cut into blocks, dealt anew each round.
CROWD = 96
#: Points in a block of a component that is compared as a whole.
BLOCK = 4096
#: A descent ends with the round that adds less than this share of links, or after so many rounds.
LEAST_NEWS = 0.002
MOST_ROUNDS = 10
#: The audit compares so many points with all; below this recall the lists are doubled, so many times at most.
AUDITED = 1024
LEAST_RECALL = 0.98
MOST_DESCENTS = 4
#: A product of two unit vectors in half precision is off by less than this.
HALF = 0.002

EDGES = "a long, b long, sim double"
Batches = Iterator[pa.RecordBatch]
#: Of a group: columns of rows, any number of times.
Work = Callable[[pa.Table], Iterator[tuple[np.ndarray, ...]]]


def _vectors(column: pa.Array) -> list[np.ndarray]:
    """The rows of a list column, without nulls in it, as views in double precision."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    ends = np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False))
    return np.split(values, ends[:-1]) if len(ends) else []


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so that no square overflows or vanishes."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _halves(column: pa.Array, start: int, end: int) -> np.ndarray:
    """Rows of a binary column of half-precision vectors of one size."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[start] : offsets[end]]
    return data.view(np.float16).reshape(end - start, -1).astype(np.float32)


def _new(table: pa.Table, names: list[str]) -> np.ndarray:
    """True where one of the columns differs from the row before."""
    new = np.zeros(table.num_rows, bool)
    for name in names:
        column = table.column(name).combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        codes = column.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return new


def grouped(work: Work, names: list[str], most: int, schema: list[str]) -> Callable[[Batches], Batches]:
    """A function of sorted batches that calls ``work`` with groups: rows with equal ``names``, or ``most`` rows of them."""

    def cut(rest: pa.Table, last: bool) -> tuple[list[pa.Table], pa.Table]:
        starts = np.flatnonzero(_new(rest, names))
        borders = [0, *starts.tolist(), rest.num_rows]
        pieces = [
            (begin, min(begin + most, end)) for a, end in zip(borders[:-1], borders[1:], strict=True) for begin in range(a, end, most)
        ]
        if not last and pieces and pieces[-1][1] - pieces[-1][0] < most:  # its group may go on
            begin = pieces.pop()[0]
            return [rest.slice(a, b - a) for a, b in pieces], rest.slice(begin)
        return [rest.slice(a, b - a) for a, b in pieces], rest.slice(rest.num_rows)

    def run(batches: Batches) -> Batches:
        rest: pa.Table | None = None
        ended = False
        while not ended:
            batch = next(batches, None)
            ended = batch is None
            if batch is not None and batch.num_rows:
                new = pa.Table.from_batches([batch])
                rest = new if rest is None else pa.concat_tables([rest, new])
            if rest is None or not rest.num_rows:
                continue
            pieces, rest = cut(rest.combine_chunks(), ended)
            found = [part for piece in pieces for part in work(piece)]
            if found:
                columns = [np.concatenate(parts) for parts in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=schema)

    return lean(run)


def _whole(table: pa.Table, name: str) -> pa.Array:
    column = table.column(name).combine_chunks()
    return column.chunk(0) if isinstance(column, pa.ChunkedArray) else column


def _longs(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _closest(sim: np.ndarray, allowed: np.ndarray, most: int) -> np.ndarray:
    """Which entries of each row are allowed and among its ``most`` largest allowed ones (more with ties)."""
    if sim.shape[1] <= most:
        return allowed
    sim = np.where(allowed, sim, -np.inf)
    least = np.partition(sim, sim.shape[1] - most, axis=1)[:, sim.shape[1] - most]
    return allowed & (sim >= least[:, None])


def sketches(points: DataFrame, trees: list[int]) -> DataFrame:
    """``points`` (cid, label, vector) with ``half`` (the unit vector in half precision) and a code for each tree.

    A code has the signs of 62 random projections, the first one in the highest bit.
    """

    def run(batches: Batches) -> Batches:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            rows = _vectors(batch.column("vector"))
            halves: list[bytes] = [b""] * len(rows)
            codes = np.zeros((len(rows), len(trees)), np.int64)
            sizes = np.array([len(row) for row in rows])
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                units = unit(np.stack([rows[i] for i in at]))
                for place, half in zip(at, units.astype(np.float16), strict=True):
                    halves[place] = half.tobytes()
                for k, tree in enumerate(trees):
                    if (tree, size) not in planes:
                        planes[tree, size] = np.random.default_rng([tree, int(size)]).standard_normal((int(size), 62))
                    codes[at, k] = (units @ planes[tree, size] > 0) @ (np.int64(1) << np.arange(61, -1, -1, dtype=np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * len(trees)), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("cid"), batch.column("label"), pa.array(halves, pa.binary()), lists], names=["cid", "label", "half", "codes"]
            )

    return shipped(points).select("cid", "label", "vector").mapInArrow(lean(run), "cid long, label string, half binary, codes array<long>")


def first_lists(points: DataFrame, home: DataFrame | None, trees: list[int], most: int) -> DataFrame:
    """Edges from every point to its nearest ones in its block of each tree, without points of its own component.

    ``home`` (cid, root) has the components; a point that it lacks is one by itself.
    """
    coded = sketches(points, trees)
    coded = coded.withColumn("root", F.col("cid")) if home is None else _at_home(coded, home)
    spread = coded.select(
        "cid", "root", "label", "half", F.posexplode("codes").alias("tree", "code"), F.octet_length("half").alias("size")
    )
    key = ["tree", "label", "size"]
    # a range should hold some blocks: its borders cut the blocks there
    most_parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(most_parts, points.count() * len(trees) // (16 * LEAF)))
    # points with equal codes are told apart, so that no range is larger than others
    ranged = spread.withColumn("salt", F.xxhash64("cid")).repartitionByRange(parts, *key, "code", "salt")

    def nearest(table: pa.Table) -> Iterator[tuple[np.ndarray, ...]]:
        ids, root = _longs(table, "cid"), _longs(table, "root")
        rows = _halves(_whole(table, "half"), 0, len(ids))
        sim = rows @ rows.T
        i, j = np.nonzero(_closest(sim, root[:, None] != root[None, :], most))
        yield ids[i], ids[j], sim[i, j].astype(np.float64)

    return ranged.sortWithinPartitions(*key, "code", "salt").mapInArrow(grouped(nearest, key, LEAF, ["a", "b", "sim"]), EDGES)


def _at_home(rows: DataFrame, home: DataFrame) -> DataFrame:
    return rows.join(home.withColumnRenamed("cid", "home"), rows["cid"] == F.col("home"), "left").select(
        *(rows[name] for name in rows.columns), F.coalesce("root", "cid").alias("root")
    )


def neighbour_lists(edges: DataFrame, most: int) -> DataFrame:
    """The ``most`` nearest of every point among ``edges`` (a, b, sim, born) taken both ways; ``born`` is the first round."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim", "born"))
    once = both.groupBy("a", "b").agg(F.max("sim").alias("sim"), F.min("born").alias("born"))
    place = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    return once.withColumn("place", place).where(F.col("place") <= most).drop("place")


def local_join(halves: DataFrame, lists: DataFrame, most: int, born: int) -> DataFrame:
    """Edges between neighbours of one point, of which one is new and which are closer than what either knows.

    ``halves`` (cid, root, half). Neighbours of a point are those in its list and those in whose lists it is. A point with
    very many is cut into blocks by a hash that changes with the round.
    """
    fresh = (F.col("born") == born - 1).alias("fresh")
    members = lists.select(F.col("a").alias("centre"), F.col("b").alias("member"), fresh).union(
        lists.select(F.col("b").alias("centre"), F.col("a").alias("member"), fresh)
    )
    # centres without news have nothing to join
    about = members.groupBy("centre").agg(F.count("*").alias("n"), F.max("fresh").alias("news")).where("news")
    dealt = members.join(about.select("centre", "n"), "centre").select(
        "centre", "member", "fresh", F.pmod(F.xxhash64("member", F.lit(born)), F.ceil(F.col("n") / CROWD)).alias("block")
    )
    known = lists.groupBy(F.col("a").alias("known")).agg(F.count("*").alias("places"), F.min("sim").alias("least"))
    least = F.when(F.col("places") >= most, F.col("least")).otherwise(-2.0).alias("floor")
    sent = (
        dealt.join(halves, dealt["member"] == halves["cid"])
        .join(known, F.col("member") == F.col("known"), "left")
        .select("centre", "block", "member", "fresh", "root", "half", F.coalesce(least, F.lit(-2.0)).alias("floor"))
    )

    def join(table: pa.Table) -> Iterator[tuple[np.ndarray, ...]]:
        ids, at = np.unique(_longs(table, "member"), return_index=True)
        new = np.zeros(len(ids), bool)
        np.logical_or.at(new, np.searchsorted(ids, _longs(table, "member")), table.column("fresh").to_numpy())
        if not new.any():
            return
        root, floor = _longs(table, "root")[at], table.column("floor").to_numpy()[at]
        rows = _halves(_whole(table, "half"), 0, table.num_rows)[at]
        sim = (rows @ rows.T).astype(np.float64)
        allowed = (new[:, None] | new[None, :]) & (sim > floor[:, None]) & (root[:, None] != root[None, :])
        i, j = np.nonzero(_closest(sim, allowed, most))
        yield ids[i], ids[j], sim[i, j]

    work = grouped(join, ["centre", "block"], 1 << 30, ["a", "b", "sim"])
    return sent.repartition("centre", "block").sortWithinPartitions("centre", "block").mapInArrow(work, EDGES)


def cosine(a: Column, b: Column) -> Column:
    """Of two arrays in double precision."""

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0.0), lambda s, v: s + v)

    def scaled(x: Column) -> Column:
        return F.transform(x, lambda v: v.cast("double") / F.array_max(F.transform(x, lambda u: F.abs(u).cast("double"))))

    def square(x: Column) -> Column:
        return total(F.transform(x, lambda v: v * v))

    a, b = scaled(a), scaled(b)
    return total(F.zip_with(a, b, lambda u, v: u * v)) / F.sqrt(square(a) * square(b))


def links_of(points: DataFrame, edges: DataFrame, threshold: float) -> DataFrame:
    """(a, b) with a < b: the pairs of ``edges`` whose cosine in double precision is at the threshold or above."""
    near = edges.where(F.col("sim") >= threshold - HALF)
    ends = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    pairs = stored(near.select(*ends, "sim").groupBy("a", "b").agg(F.max("sim").alias("sim")))
    sure = pairs.where(F.col("sim") >= threshold + HALF).select("a", "b")
    left, right = (points.select(F.col("cid").alias(side), F.col("vector").alias(f"vector_{side}")) for side in "ab")
    close = pairs.where(F.col("sim") < threshold + HALF).join(left, "a").join(right, "b")
    return sure.union(close.where(cosine(F.col("vector_a"), F.col("vector_b")) >= threshold).select("a", "b"))


class Graph:
    """The state of a descent: neighbour lists and links, each a written table."""

    def __init__(self, points: DataFrame, threshold: float) -> None:
        self.points, self.threshold = points, threshold
        self.lists: DataFrame | None = None
        self.links = stored(points.select(F.col("cid").alias("a"), F.col("cid").alias("b")).limit(0))
        self.home: DataFrame | None = None

    def descend(self, trees: list[int], most: int) -> None:
        """Lists from new trees and the present ones, refined until a round finds few new links."""
        halves = sketches(self.points, []).select("cid", "half")
        halves = halves.withColumn("root", F.col("cid")) if self.home is None else _at_home(halves, self.home)
        halves = stored(halves)
        edges = first_lists(self.points, self.home, trees, most).withColumn("born", F.lit(0))
        if self.lists is not None:
            edges = edges.union(self.lists.withColumn("born", F.lit(0)))
        near = F.sum((F.col("sim") >= self.threshold).cast("long"))
        lists = stored(neighbour_lists(edges, most))
        known = lists.agg(near).first()[0] or 0
        for born in range(1, MOST_ROUNDS + 1):
            found = local_join(halves, lists, most, born).withColumn("born", F.lit(born))
            lists = stored(neighbour_lists(lists.union(found), most))
            now = lists.agg(near).first()[0] or 0
            if now - known <= LEAST_NEWS * now:
                break
            known = now
        self.lists = lists

    def link(self) -> bool:
        """Adds the links of the lists and joins components; False if there was no new link."""
        new = stored(links_of(self.points, self.lists, self.threshold).join(self.links, ["a", "b"], "left_anti"))
        if new.isEmpty():
            return False
        self.links = stored(self.links.union(new))
        self.home = stored(components(self.links.select(F.col("a").alias("u"), F.col("b").alias("v")))).select(
            F.col("node").alias("cid"), "root"
        )
        return True

    def saturated(self, most: int) -> DataFrame:
        """Roots of components with a point all of whose places are links."""
        near = self.lists.where(F.col("sim") >= self.threshold - HALF)
        full = near.groupBy("a").agg(F.count("*").alias("n")).where(F.col("n") >= most)
        return _at_home(full.select(F.col("a").alias("cid")), self.home).select("root").distinct()

    def outside(self) -> None:
        """Only the edges between components are left in the lists."""
        left = _at_home(self.lists.withColumnRenamed("a", "cid"), self.home)
        there = left.select(F.col("cid").alias("a"), F.col("b").alias("cid"), "sim", "born", F.col("root").alias("own"))
        both = _at_home(there, self.home)
        self.lists = stored(both.where("root <> own").select("a", F.col("cid").alias("b"), "sim", "born"))


def neighbour_graph(points: DataFrame, threshold: float, most: int, trees: int) -> tuple[DataFrame, DataFrame]:
    """Components (cid, root), without the points that are one by themselves, and the links (cid, n) of each; audited."""
    graph = Graph(points, threshold)
    whole: list[DataFrame] = []
    seed = 0
    for _ in range(MOST_DESCENTS):
        while True:
            graph.descend(list(range(seed, seed + trees)), most)
            seed += trees
            if not graph.link():
                break
            full = stored(graph.saturated(most))
            if full.isEmpty():
                break
            whole.append(full)
            graph.outside()
        if graph.home is None:
            graph.home = stored(points.select("cid", F.col("cid").alias("root")).limit(0))
        roots = reduce(DataFrame.union, whole).select(F.col("root").alias("cid")) if whole else None
        # components may have met since
        full = _at_home(roots, graph.home).select("root").distinct() if whole else graph.home.select("root").limit(0)
        counts = stored(weights(points, graph.links, graph.home, stored(full), threshold))
        if audit(points, counts, threshold) >= LEAST_RECALL:
            break
        most *= 2
    else:
        warnings.warn("NN-descent: the audit found less than the recall asked for", stacklevel=2)
    return graph.home, counts


def weights(points: DataFrame, links: DataFrame, home: DataFrame, whole: DataFrame, threshold: float) -> DataFrame:
    """(cid, n): rows linked with each point that has any, its own copies not counted."""
    size = points.select("cid", "copies")
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rooted = _at_home(both.withColumnRenamed("a", "cid"), home)
    listed = rooted.join(whole, "root", "left_anti").select(F.col("cid").alias("point"), F.col("b").alias("cid"))
    few = listed.join(size, "cid").groupBy(F.col("point").alias("cid")).agg(F.sum("copies").alias("n"))
    return few.union(counted(points, home, whole, threshold))


def counted(points: DataFrame, home: DataFrame, whole: DataFrame, threshold: float) -> DataFrame:
    """(cid, n): the same for points of the components in ``whole``, every point compared with all of its component.

    A component is cut into blocks; a block is sent once for each other one of its component, and counts come back.
    """
    inside = _at_home(points.select("cid", "copies", "vector"), home).join(whole, "root", "left_semi")
    sizes = inside.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = inside.join(sizes, "root").withColumn("block", F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"))
    pair = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    sent = placed.select("root", "cid", "copies", "vector", "block", pair).select(
        "root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "cid", "copies", "vector"
    )

    def count(table: pa.Table) -> Iterator[tuple[np.ndarray, ...]]:
        ids, copies, block = _longs(table, "cid"), _longs(table, "copies"), _longs(table, "block")
        rows = unit(np.stack(_vectors(_whole(table, "vector"))))
        left = block == table.column("i")[0].as_py()
        right = block == table.column("j")[0].as_py()
        same = table.column("i")[0] == table.column("j")[0]
        n = np.zeros(len(ids), np.int64)
        columns = np.flatnonzero(right)
        for begin in range(0, int(left.sum()), 512):
            some = np.flatnonzero(left)[begin : begin + 512]
            near = rows[some] @ rows[columns].T >= threshold
            if same:
                near[np.arange(len(some)), np.searchsorted(columns, some)] = False
            n[some] += near @ copies[columns]
            if not same:
                n[columns] += copies[some] @ near
        yield ids, n

    work = grouped(count, ["root", "i", "j"], 1 << 30, ["cid", "n"])
    dealt = shipped(sent).repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    return dealt.mapInArrow(work, "cid long, n long").groupBy("cid").agg(F.sum("n").alias("n"))


def audit(points: DataFrame, found: DataFrame, threshold: float) -> float:
    """Recall of links over at most ``AUDITED`` points, chosen by a hash of their vectors and compared with all points."""
    asked = points.select("cid", "label", "vector").orderBy(F.xxhash64("vector"), "cid").limit(AUDITED).toArrow()
    if not asked.num_rows:
        return 1.0
    queries: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}
    label, vectors = asked.column("label").to_pylist(), _vectors(_whole(asked, "vector"))
    ids = asked.column("cid").to_numpy()
    groups = [(name, len(v)) for name, v in zip(label, vectors, strict=True)]
    for group in set(groups):
        at = [i for i, g in enumerate(groups) if g == group]
        queries[group] = ids[at], unit(np.stack([vectors[i] for i in at]))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows, own = _vectors(batch.column("vector")), batch.column("cid").to_numpy()
            copies = batch.column("copies").to_numpy()
            groups = [(name, len(v)) for name, v in zip(batch.column("label").to_pylist(), rows, strict=True)]
            for group in set(groups) & set(queries):
                at = np.array([i for i, g in enumerate(groups) if g == group])
                of, asks = queries[group]
                near = (asks @ unit(np.stack([rows[i] for i in at])).T >= threshold) & (of[:, None] != own[at][None, :])
                yield pa.RecordBatch.from_arrays([pa.array(of), pa.array(near @ copies[at])], names=["cid", "n"])

    compared = points.select("cid", "label", "vector", "copies").mapInArrow(lean(run), "cid long, n long")
    true = compared.groupBy("cid").agg(F.sum("n").alias("true"))
    met = true.join(found, "cid", "left").agg(F.sum("true"), F.sum(F.least(F.col("true"), F.coalesce("n", F.lit(0))))).first()
    return met[1] / met[0] if met[0] else 1.0


def usable(vector: Column) -> Column:
    """No null or non-finite component, and one that is not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, neighbours: int = NEIGHBOURS, trees: int = TREES) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per row of ``vectors`` (vec_id, embedding, label).

    Rows of one label (never null) and one dimension are linked if the cosine of their embeddings is ``threshold`` or above.
    ``n_links`` counts the rows linked directly, ``component_id`` is the smallest vec_id that links reach, the own included,
    and a row is kept if it is its component's id. Rows whose embedding is null, empty, zero or holds a null or non-finite
    component have no links. Rows of one id are different rows; a null id is no component's id unless it has no other.
    """
    kind = "array<double>" if "double" in vectors.schema["embedding"].dataType.simpleString() else "array<float>"
    rows = vectors.select(
        vectors["vec_id"].alias("vec_id"), vectors["label"].cast("string").alias("label"), vectors["embedding"].cast(kind).alias("vector")
    )
    key = F.unhex(F.sha2(F.concat_ws(" ", F.col("label"), F.col("vector").cast("string")), 256))
    keyed = rows.withColumn("key", F.when(F.col("label").isNotNull() & usable(F.col("vector")), key))
    alike = [F.any_value(name).alias(name) for name in ("label", "vector")]
    classes = keyed.where("key is not null").groupBy("key").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("smallest"), *alike
    )
    points = stored(classes.withColumn("cid", F.monotonically_increasing_id()))
    home, counts = neighbour_graph(points, threshold, neighbours, max(2, trees))
    rooted = _at_home(points.select("cid", "key", "copies", "smallest"), home)
    named = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    about = rooted.join(named, "root").join(counts, "cid", "left").select(
        "key", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    return keyed.select("vec_id", "key").join(about, "key", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(F.col("n_links").isNull(), F.lit(True)).otherwise(F.col("vec_id").eqNullSafe(F.col("component_id"))).alias("kept"),
    )
