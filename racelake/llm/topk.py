"""Exact top-k by inner product with a dual cover tree.

A cover tree is built level by level: on a sample, by farthest-first nets whose centres are the nodes; the
leaves then take every row by its nearest centre, are cut into blocks of at most ``BLOCK`` rows, and get
as covering radius the largest distance of any of their rows. Queries are rows, so the same leaves
index queries and data together.

Two nodes, one of queries and one of data, cannot hold a better score than
``<c, d> + r|d| + s|c| + rs`` (centres c, d, covering radii r, s). A query group first scores its own and its
closest blocks; its worst kth score then prunes pairs of nodes from the root down. In the pairs that survive, every
query is tested against the data node by itself (``<q, d> + s|q|``, its own kth score). What is left is
scored in full, in integers.

The data stay in their blocks and the queries travel: a data row is sent once per group of up to ``BLOCK`` queries of
near leaves, a query once per data block that may hold one of its best.

Cases: rows whose vector is null, empty or holds null or non-finite components take no part, nor do rows
without vec_id; vectors of different lengths are an error; repeated rows (vec_id and vector) are one row; of rows with
one vec_id and different vectors each is a candidate, the smallest vector (by its components in order) is the query, and
none is a candidate of that query; components and scores beyond a long are held at its ends;
ties of score go to the smaller vec_id; fewer than k candidates give as many ranks; further columns are
ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from racelake.llm.staging import staged, tidy
from racelake.shipping import ship

SCALE = 1024
SAMPLE = 4096
"""rows (expected) that the tree's centres are chosen from"""
FANOUT = 8
LEAVES = 256
"""leaves at most; the tree's size does not depend on the number of rows"""
BLOCK = 4096
"""rows of a leaf, or queries, that meet in one task at most (expected)"""
FIRST = 4
"""closest leaves that a query group scores before pruning"""


def prepare(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): vectors of integers, floor(scale * component)."""
    fit = F.size("embedding") > 0
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    whole = F.transform("embedding", lambda v: F.floor(v.cast("double") * scale).cast("long"))
    kept = rows.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fit & finite)
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("x")).dropDuplicates(["vec_id", "x"])


def _net(points: np.ndarray, size: int) -> np.ndarray:
    """Rows of points, each the farthest from those before."""
    chosen = [0]
    near = np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < min(size, len(points)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, np.linalg.norm(points - points[chosen[-1]], axis=1))
    return points[chosen]


class Tree:
    """Levels of centres; every centre of a level belongs to its nearest one in the level above."""

    def __init__(self, sample: np.ndarray):
        self.levels: list[np.ndarray] = []
        size = FANOUT
        net = _net(sample, LEAVES)  # a prefix of a farthest-first order is the net of a higher level
        while size < len(net):
            self.levels.append(net[:size])
            size *= FANOUT
        self.levels.append(net)

    def leaf_of(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest leaf of each row, and the distance to its centre."""
        centres = self.levels[-1]
        squared = (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)
        leaf = squared.argmin(1)
        return leaf, np.linalg.norm(points - centres[leaf], axis=1)

    def parents(self) -> list[np.ndarray]:
        """For every level but the first, the index of each centre's parent."""
        return [
            np.linalg.norm(low[:, None] - high[None], axis=2).argmin(1) for high, low in zip(self.levels, self.levels[1:])
        ]


def bounds(c: np.ndarray, r: np.ndarray, d: np.ndarray, s: np.ndarray) -> np.ndarray:
    """The best score that any pair of members of nodes (c, r) and (d, s) can have."""
    c_norm, d_norm = np.linalg.norm(c, axis=1), np.linalg.norm(d, axis=1)
    # the slack covers rounding of the centres' and radii's floats
    slack = np.outer(c_norm + r, d_norm + s) * 1e-9 + 1e-3
    return c @ d.T + np.outer(r, d_norm) + np.outer(c_norm, s) + np.outer(r, s) + slack


def _radii(tree: Tree, leaf_radius: np.ndarray) -> list[np.ndarray]:
    """Covering radius of every node of every level, from those of the leaves; -1 for empty nodes."""
    out = [leaf_radius]
    for parent, high, low in zip(reversed(tree.parents()), reversed(tree.levels[:-1]), reversed(tree.levels[1:])):
        step = np.linalg.norm(low - high[parent], axis=1) + out[0]
        radius = np.full(len(high), -1.0)
        np.maximum.at(radius, parent, np.where(out[0] < 0, -1.0, step))
        out.insert(0, radius)
    return out


def surviving(tree: Tree, query_radius: np.ndarray, data_radius: np.ndarray, worst: np.ndarray) -> np.ndarray:
    """Per query leaf and data leaf, whether the pair may hold a score of at least the query leaf's worst kth score.

    Both trees are descended together: a pair of nodes goes on only if its bound reaches the smallest worst
    score below the query node.
    """
    q_radii, d_radii, parents = _radii(tree, query_radius), _radii(tree, data_radius), tree.parents()
    need = [worst]
    for parent, high in zip(reversed(parents), reversed(tree.levels[:-1])):
        least = np.full(len(high), np.inf)
        np.minimum.at(least, parent, need[0])
        need.insert(0, least)
    alive = None
    for level, centres in enumerate(tree.levels):
        fits = bounds(centres, np.maximum(q_radii[level], 0), centres, np.maximum(d_radii[level], 0)) >= need[level][:, None]
        fits &= (q_radii[level] >= 0)[:, None] & (d_radii[level] >= 0)[None]
        alive = fits if alive is None else fits & alive[parents[level - 1]][:, parents[level - 1]]
    return alive


def query_groups(tree: Tree, sizes: np.ndarray, most: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Per query leaf its first group and its number of groups: near leaves share one, a large leaf is split."""
    path = np.arange(len(sizes))
    keys = [path]
    for parent in reversed(tree.parents()):
        path = parent[path]
        keys.append(path)
    first, parts = np.zeros(len(sizes), int), np.maximum(-(-sizes // most), 1)
    group, held = 0, 0
    for leaf in np.lexsort(keys):
        if held and held + sizes[leaf] > most:
            group, held = group + 1, 0
        first[leaf] = group
        held += sizes[leaf]
        if held > most:
            group, held = group + parts[leaf], 0
    return first, parts


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(flat) != dims * len(column):
        raise ValueError("vectors differ in length")
    return flat.reshape(-1, dims)


def _place(tree: Tree, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf, distance = tree.leaf_of(_matrix(batch.column("x"), dims).astype(np.float64))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaf.astype(np.int32)), pa.array(distance)], names=[*batch.schema.names, "leaf", "distance"]
            )

    return run


def reach(tree: Tree, x: np.ndarray, leaf: np.ndarray, worst: np.ndarray, alive: np.ndarray, data_radius: np.ndarray) -> np.ndarray:
    """Per query (vector, leaf, worst kth score) and data leaf, whether it has to be scored."""
    zero = np.zeros(len(x))
    return alive[leaf] & (bounds(x, zero, tree.levels[-1], np.maximum(data_radius, 0)) >= worst[:, None])


def _travel(tree: Tree, dims: int, alive: np.ndarray, data_radius: np.ndarray):
    """Queries with the data leaves that they have to visit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("query_x"), dims).astype(np.float64)
            worst = batch.column("worst").fill_null(-np.inf).to_numpy(zero_copy_only=False)
            visits = reach(tree, x, batch.column("leaf").to_numpy(), worst, alive, data_radius)
            offsets = pa.array(np.concatenate([[0], np.cumsum(visits.sum(1))]), pa.int32())
            leaves = pa.ListArray.from_arrays(offsets, pa.array(np.nonzero(visits)[1], pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("query_id"), batch.column("query_x"), batch.column("q_block"), leaves], names=["query_id", "query_x", "q_block", "visits"]
            )

    return run


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer inner products; those beyond a long are held at its ends."""
    largest = max(abs(int(f(m))) for m in (q, x) for f in (np.min, np.max))
    if largest**2 * x.shape[1] < 1 << 53:  # sums of products stay exact
        return (q.astype(np.float64) @ x.T.astype(np.float64)).astype(np.int64)
    if largest**2 * x.shape[1] < 1 << 63:
        return q @ x.T
    ends = np.iinfo(np.int64)
    return np.clip(q.astype(object) @ x.T.astype(object), ends.min, ends.max).astype(np.int64)


def _score(k: int, dims: int):
    """Rows of one (query block, data block): its queries and data, to each query's k best."""

    def run(queries: pa.Table, data: pa.Table) -> pa.Table:
        found = [[], [], []]
        if len(queries) and len(data):
            data = data.sort_by("vec_id").combine_chunks()
            ids, x = data.column("vec_id").to_numpy(), _matrix(data.column("x").combine_chunks(), dims)
            for lo in range(0, len(queries), 256):
                part = queries.slice(lo, 256).combine_chunks()
                query_ids = part.column("query_id").to_numpy()
                for query, row in zip(query_ids, _products(_matrix(part.column("query_x").combine_chunks(), dims), x)):
                    other = ids != query
                    row, names = row[other], ids[other]
                    if len(row) > k:  # whatever ties with the kth stays for the sort
                        near = np.flatnonzero(row >= np.partition(row, len(row) - k)[len(row) - k])
                        row, names = row[near], names[near]
                    best = np.argsort(-row.astype(object) if len(row) and row.min() == np.iinfo(np.int64).min else -row, kind="stable")[:k]
                    for out, values in zip(found, (np.full(len(best), query), names[best], row[best])):
                        out.append(values)
        columns = [pa.array(np.concatenate(c) if c else [], pa.int64()) for c in found]
        return pa.Table.from_arrays(columns, names=["query_id", "vec_id", "score"])

    return run


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(rows: DataFrame, is_query: Column, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows (vec_id, embedding) that ``is_query`` names, against all rows.

    To the driver come the sample, and one radius, size and worst score per leaf.
    """
    spark = ship(rows.sparkSession)
    vectors = staged(prepare(rows), "vectors")
    empty = "query_id long, rank int, vec_id long, score long"
    n = vectors.count()
    if n == 0:
        return spark.createDataFrame([], empty)
    chance = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = vectors.filter(chance < min(1.0, SAMPLE / n)).orderBy("vec_id").select("x").toPandas()["x"]
    if not len(sample):
        sample = vectors.orderBy("vec_id").limit(1).toPandas()["x"]
    dims = len(sample.iloc[0])
    tree = Tree(np.stack(sample.to_numpy()).astype(np.float64))
    shape = "vec_id long, x array<long>, leaf int, distance double"
    placed = staged(vectors.mapInArrow(tidy(_place(tree, dims)), shape), "vector-leaves")
    marked = placed.withColumn("_query", F.coalesce(is_query, F.lit(False)))
    leaves = len(tree.levels[-1])

    sizes, data_radius, query_sizes, query_radius = np.zeros(leaves, int), np.full(leaves, -1.0), np.zeros(leaves, int), np.full(leaves, -1.0)
    figures = marked.groupBy("leaf").agg(
        F.count("*").alias("n"), F.max("distance").alias("r"), F.count_if("_query").alias("qn"), F.max(F.when(F.col("_query"), F.col("distance"))).alias("qr")
    )
    for f in figures.collect():
        sizes[f["leaf"]], data_radius[f["leaf"]] = f["n"], f["r"]
        query_sizes[f["leaf"]], query_radius[f["leaf"]] = f["qn"], f["qr"] if f["qn"] else -1.0
    if not query_sizes.any():
        return spark.createDataFrame([], empty)
    blocks = np.maximum(-(-sizes // BLOCK), 1)
    group, parts = query_groups(tree, query_sizes)

    def by_leaf(values: np.ndarray, leaf: str = "leaf") -> Column:
        return F.get(F.array(*(F.lit(int(v)) for v in values)), F.col(leaf))

    # of rows with one vec_id the smallest is the query
    asked = marked.filter("_query").groupBy("vec_id").agg(F.min(F.struct("x", "leaf")).alias("least"))
    queries = asked.select(F.col("vec_id").alias("query_id"), F.col("least.x").alias("query_x"), F.col("least.leaf").alias("leaf"))
    spread = F.pmod(F.xxhash64("query_id"), by_leaf(parts).cast("long"))
    queries = staged(queries.withColumn("q_block", (by_leaf(group) + spread).cast("int")), "queries")
    data = placed.select("vec_id", "x", "leaf", F.pmod(F.xxhash64("vec_id", "x"), by_leaf(blocks).cast("long")).cast("int").alias("block"))

    def scored(alive: np.ndarray, asking: DataFrame) -> DataFrame:
        """The best of the pairs of leaves in ``alive``, for queries with their ``worst`` score so far."""
        # per data leaf the ranges of groups that visit it: no more rows, and ranges in a row, than leaves
        ranges = [(d, sorted({(int(group[q]), int(group[q] + parts[q] - 1)) for q in np.flatnonzero(alive[:, d])})) for d in range(leaves)]
        visited = spark.createDataFrame([r for r in ranges if r[1]], "leaf int, ranges array<struct<lo: int, hi: int>>")
        moved = asking.mapInArrow(
            tidy(_travel(tree, dims, alive, data_radius)), "query_id long, query_x array<long>, q_block int, visits array<int>"
        ).withColumn("leaf", F.explode("visits"))
        moved = moved.withColumn("block", F.explode(F.sequence(F.lit(0), by_leaf(blocks) - 1)))
        q = moved.select("query_id", "query_x", F.concat_ws(":", "q_block", "leaf", "block").alias("cell"))
        d = data.join(F.broadcast(visited), "leaf").withColumn("range", F.explode("ranges")).withColumn(
            "q_block", F.explode(F.sequence("range.lo", "range.hi"))
        ).select("vec_id", "x", F.concat_ws(":", "q_block", "leaf", "block").alias("cell"))
        result = q.groupBy("cell").cogroup(d.groupBy("cell")).applyInArrow(_score(k, dims), "query_id long, vec_id long, score long")
        return staged(result, "scores")

    centres = tree.levels[-1]
    closeness = centres @ centres.T
    first = np.zeros((leaves, leaves), bool)
    for q in np.flatnonzero(query_sizes):
        best = [int(d) for d in np.argsort(-closeness[q], kind="stable") if sizes[d]]
        chosen = [int(q)]  # its own leaf, then the closest until there are rows enough
        for d in best:
            if len(chosen) >= FIRST and sizes[chosen].sum() > k:
                break
            if d != q:
                chosen.append(d)
        first[q, chosen] = True
    begun = scored(first, queries.withColumn("worst", F.lit(None).cast("double")))
    kth = _best(begun, k).groupBy("query_id").agg(F.min("score").alias("worst"), F.count("*").alias("n"))
    # a double may lie above the long it stands for; twice the rounding is taken off
    low = F.col("worst").cast("double")
    kth = kth.select("query_id", F.when(F.col("n") >= k, low - F.abs(low) * 1e-15).alias("worst"))
    known = staged(queries.join(kth, "query_id", "left"), "queries-begun")
    worst = np.full(leaves, np.inf)
    for r in known.groupBy("leaf").agg(F.min(F.coalesce("worst", F.lit(float("-inf")))).alias("worst")).collect():
        worst[r["leaf"]] = r["worst"]
    rest = surviving(tree, query_radius, data_radius, worst) & ~first
    found = begun.unionByName(scored(rest, known)) if rest.any() else begun
    return _best(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def query(spark: SparkSession, folder: str) -> DataFrame:
    rows = ship(spark).read.parquet(f"{folder}/embeddings.parquet")
    return search(rows, F.col("vec_id") % 100 == 0, 10)
