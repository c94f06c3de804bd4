"""Hard negatives by angular triangle filtering.

Every row stores its norm and its angles to ``REFERENCES`` directions. The angle between two rows lies between
the largest difference of their angles to a direction and the smallest sum, so its cosine, times both norms and
widened for rounding, bounds their inner product without looking at their components. Only pairs whose bounds
reach the window at hand are scored, in integers.

Rows are sorted into blocks of at most ``BLOCK`` by their nearest direction and their angle to it; a block keeps
the range of its norms and of its angles to all directions, which bounds the scores of all its rows at once.
An anchor first meets the block it lies in, where its positives so far set a bound; then it travels, with its
components, to the blocks whose bounds reach it, and a second time to those that reach its windows of negatives.
Rows stay in their blocks; of a block every (anchor, positive) gets only its best few.

The directions come from a sample of ``SAMPLE`` rows (expected). They decide how much is pruned, never the
result; on vectors without any structure little is.

Cases: rows take no part whose label or vector is null or whose vector holds a null or non-finite component;
shorter vectors are filled up with zeros; a vector of zeros scores 0 with all; rows of the anchor's own vec_id are
neither its positives nor its negatives, and rows of one vec_id take part one by one; a null vec_id is no anchor
and cannot be named, so it takes no part either; ties go to the smaller vec_id; scores beyond a long are held at its ends; further columns
are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from racelake.llm.staging import staged
from racelake.shipping import ship

SCALE = 256
REFERENCES = 12
SAMPLE = 1024
BLOCK = 4096
"""rows of a block at most"""
CHUNK = 8192
"""anchors that visit a block together (expected)"""
LANES = 8
"""groups of blocks, at least, that anchors are compared with by their bounds"""
SLICE = 64
"""anchors compared with a block at a time"""
ANGLE_ERROR = 1e-7
"""no smaller than the rounding of an arc cosine and of sums and differences of two"""

_LONG = np.iinfo(np.int64)
_END = 2.0**63


# --- exact scores and their bounds ---


def exact_scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of all rows of two matrices of whole numbers, as longs."""
    if not a.size or not x.size:
        return np.zeros((len(a), len(x)), np.int64)
    if np.abs(a).max() * np.abs(x).max() * a.shape[1] < 2.0**53:  # every partial sum is a whole double
        return (a @ x.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    products = whole(a).dot(whole(x).T)
    return np.vectorize(lambda v: min(max(v, _LONG.min), _LONG.max), otypes=[np.int64])(products)


def describe(x: np.ndarray, directions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms of rows and their angles to directions of length one."""
    largest = np.abs(x).max(1, initial=0)
    unit = x / np.where(largest > 0, largest, 1)[:, None]
    length = np.linalg.norm(unit, axis=1)
    unit /= np.where(length > 0, length, 1)[:, None]
    return largest * length, np.arccos(np.clip(unit @ directions.T, -1, 1))


def score_bounds(norm: np.ndarray, angles: np.ndarray, norms: np.ndarray, others: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest scores that rows with these norms and angles can have with each other."""
    least = np.zeros((len(norm), len(norms)))
    most = np.full_like(least, np.pi)
    for mine, theirs in zip(angles.T, others.T):
        np.maximum(least, np.abs(mine[:, None] - theirs), out=least)
        total = mine[:, None] + theirs
        np.minimum(most, np.minimum(total, 2 * np.pi - total), out=most)
    with np.errstate(all="ignore"):
        scale = np.outer(norm, norms)
        slack = scale * 1e-9 + 1e-6
        low = scale * np.cos(np.minimum(most + ANGLE_ERROR, np.pi)) - slack
        high = scale * np.cos(np.maximum(least - ANGLE_ERROR, 0)) + slack
    beyond = ~np.isfinite(scale)
    low[beyond], high[beyond] = -np.inf, np.inf
    return np.clip(low, -_END, _END), np.clip(high, -_END, _END)  # as the scores are


def _scored(a: np.ndarray, x: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, row of x, score) of the wanted pairs."""
    rows, columns = np.flatnonzero(wanted.any(1)), np.flatnonzero(wanted.any(0))
    scores = exact_scores(a[rows], x[columns])
    at = np.nonzero(wanted[np.ix_(rows, columns)])
    return rows[at[0]], columns[at[1]], scores[at]


def _first_of_each(groups: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k entries of every group, best scores first, ties by id."""
    order = np.lexsort((ids, -scores.astype(np.float64), groups)) if np.abs(scores).max(initial=0) < 1 << 53 else np.array(
        sorted(range(len(scores)), key=lambda i: (groups[i], -int(scores[i]), ids[i])), np.int64
    )
    sorted_groups = groups[order]
    first = np.searchsorted(sorted_groups, sorted_groups)
    return order[np.arange(len(order)) - first < k]


class Block:
    """The rows of a block, as arrays."""

    def __init__(self, row: pa.RecordBatch | pa.Table):
        def doubles(name: str) -> np.ndarray:
            return np.frombuffer(row.column(name)[0].as_py(), "<f8")

        self.id = row.column("block")[0].as_py()
        self.ids, self.labels = (np.frombuffer(row.column(c)[0].as_py(), "<i8") for c in ("ids", "labels"))
        self.anchors = np.frombuffer(row.column("anchors")[0].as_py(), "?")
        self.norms = doubles("norms")
        self.x, self.angles = (doubles(c).reshape(len(self.ids), -1) for c in ("x", "angles"))


def _positives(block: Block, ids, labels, x, norms, angles, worst: np.ndarray, k: int):
    """(anchor's place, row's place, score) of each anchor's first k rows of its label, those above its worst score so far."""
    out = []
    for lo in range(0, len(ids), SLICE):
        s = slice(lo, lo + SLICE)
        fit = (labels[s, None] == block.labels) & (ids[s, None] != block.ids)
        low, high = score_bounds(norms[s], angles[s], block.norms, block.angles)
        least = worst[s].copy()
        if fit.shape[1] >= k:  # k rows of this block are at least as good as the kth best lower bound
            kth = -np.partition(-np.where(fit, low, -np.inf), k - 1, axis=1)[:, k - 1]
            least = np.maximum(least, kth)
        rows, columns, scores = _scored(x[s], block.x, fit & (high >= least[:, None]))
        best = _first_of_each(rows, scores, block.ids[columns], k)
        out.append((rows[best] + lo, columns[best], scores[best]))
    return tuple(np.concatenate(p) for p in zip(*out))


def _negatives(block: Block, ids, labels, x, norms, angles, windows: list[list[tuple[int, int]]], k: int):
    """(anchor's place, window's place, row's place, score): the first k rows of other labels within each window."""
    out = []
    for lo in range(0, len(ids), SLICE):
        s = slice(lo, lo + SLICE)
        fit = (labels[s, None] != block.labels) & (ids[s, None] != block.ids)
        low, high = score_bounds(norms[s], angles[s], block.norms, block.angles)
        near = np.zeros_like(fit)
        for w in range(max(map(len, windows[s]), default=0)):
            ends = np.array([(w_[w] if w < len(w_) else (np.inf, -np.inf)) for w_ in windows[s]], np.float64)
            # a double may round a long: one step outwards keeps the window whole
            near |= (high >= np.nextafter(ends[:, :1], -np.inf)) & (low <= np.nextafter(ends[:, 1:], np.inf))
        rows, columns, scores = _scored(x[s], block.x, fit & near)
        for w in range(max(map(len, windows[s]), default=0)):
            bottom = np.array([w_[w][0] if w < len(w_) else _LONG.max for w_ in windows[s]], np.int64)
            top = np.array([w_[w][1] if w < len(w_) else _LONG.min for w_ in windows[s]], np.int64)
            inside = np.flatnonzero((scores >= bottom[rows]) & (scores <= top[rows]))
            best = inside[_first_of_each(rows[inside], scores[inside], block.ids[columns[inside]], k)]
            out.append((rows[best] + lo, np.full(len(best), w), columns[best], scores[best]))
    return tuple(np.concatenate(p).astype(np.int64) for p in zip(*out)) if out else tuple(np.zeros((4, 0), np.int64))


# --- preparation ---


def directions_of(sample: np.ndarray, count: int) -> np.ndarray:
    """Directions of length one far apart from each other, out of a sample's rows."""
    length = np.linalg.norm(sample, axis=1)
    unit = sample[length > 0] / length[length > 0, None]
    if not len(unit):
        out = np.zeros((1, sample.shape[1]))
        out[0, :1] = 1
        return out
    chosen = [0]
    nearest = unit @ unit[0]
    while len(chosen) < min(count, len(unit)) and nearest.min() < 1 - 1e-9:
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return unit[chosen]


def _usable(rows: DataFrame, is_anchor: Column, scale: int) -> DataFrame:
    """(vec_id, label, anchor, x): rows that take part, components as whole doubles."""
    def whole(v: Column) -> Column:
        scaled = F.floor(v.cast("double") * scale)
        # floor gives a long; a double beyond 2^53 has no fraction to take off
        return F.when(F.abs(v.cast("double") * scale) < 2.0**53, scaled.cast("double")).otherwise(v.cast("double") * scale)

    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double") * scale) < float("inf")))
    kept = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    return kept.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"), F.transform("embedding", whole).alias("x"),
    )


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Lists of numbers as rows of one length, filled up with zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dims))
    out[np.repeat(np.arange(len(column)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _place(directions: np.ndarray, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), dims)
            norms, angles = describe(x, directions)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("vec_id", "label", "anchor")),
                    pa.array([r.astype("<f8").tobytes() for r in x], pa.binary()), pa.array(norms),
                    pa.array([a.astype("<f8").tobytes() for a in angles], pa.binary()),
                    pa.array(angles.argmin(1).astype(np.int32)), pa.array(angles.min(1)),
                ],
                names=["vec_id", "label", "anchor", "x", "norm", "angles", "cell", "nearest"],
            )

    return run


_BLOCKS = (
    "block long, ids binary, labels binary, anchors binary, norms binary, x binary, angles binary, "
    "kinds array<long>, norm_low double, norm_high double, angle_low array<double>, angle_high array<double>"
)


def _block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows of a range to blocks: rows of one cell that follow each other."""
    made = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []
    size = 0

    def flush() -> pa.RecordBatch:
        nonlocal made, size
        rows = pa.Table.from_batches(held).combine_chunks()
        norms = rows["norm"].to_numpy()
        angles = np.frombuffer(b"".join(rows["angles"].to_pylist()), "<f8").reshape(len(rows), -1)
        labels = rows["label"].to_numpy()
        values = [
            made, rows["vec_id"].to_numpy().astype("<i8").tobytes(), labels.astype("<i8").tobytes(), rows["anchor"].to_numpy().astype("?").tobytes(),
            norms.astype("<f8").tobytes(), b"".join(rows["x"].to_pylist()), angles.tobytes(), np.unique(labels).tolist(),
            norms.min(), norms.max(), angles.min(0).tolist(), angles.max(0).tolist(),
        ]
        kinds = [pa.int64(), *[pa.binary()] * 6, pa.list_(pa.int64()), pa.float64(), pa.float64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
        names = [c.split()[0] for c in _BLOCKS.split(", ")]
        made, size = made + 1, 0
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

    cell = None
    for batch in batches:
        cells = batch.column("cell").to_numpy()
        starts = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
        for lo, hi in zip(starts, starts[1:]):
            if lo == hi:
                continue
            if size and cells[lo] != cell:
                yield flush()
            cell = cells[lo]
            while lo < hi:
                take = min(hi - lo, BLOCK - size)
                held.append(batch.slice(lo, take))
                size, lo = size + take, lo + take
                if size == BLOCK:
                    yield flush()
    if size:
        yield flush()


def index(rows: DataFrame, is_anchor: Column, scale: int = SCALE) -> DataFrame:
    """The blocks of all rows (vec_id, label, embedding) that take part. To the driver come the sample and two numbers."""
    vectors = staged(_usable(rows, is_anchor, scale), "labelled-vectors")
    figures = vectors.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("dims")).first()
    n, dims = figures["n"], figures["dims"] or 0
    chance = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = vectors.filter(chance < min(1.0, SAMPLE / max(n, 1))).select("vec_id", "x").orderBy("vec_id").toArrow()
    points = _matrix(sample["x"].combine_chunks(), dims) if sample.num_rows else np.zeros((0, dims))
    directions = directions_of(points, REFERENCES)
    placed = vectors.mapInArrow(
        _place(directions, dims), "vec_id long, label long, anchor boolean, x binary, norm double, angles binary, cell int, nearest double"
    )
    by = ["cell", "nearest", "vec_id", "_tie"]  # copies of one vector are dealt out by their id
    placed = staged(placed, "placed-vectors").withColumn("_tie", F.monotonically_increasing_id())
    ordered = placed.repartitionByRange(max(1, -(-n // BLOCK)), *by).sortWithinPartitions(*by).drop("_tie")
    return staged(ordered.mapInArrow(_block, _BLOCKS), "vector-blocks")


# --- anchors and their visits ---

_ANCHOR = "anchor long, anchor_id long, label long, x binary, norm double, angles array<double>, home long"
_ANCHOR_NAMES = [c.split()[0] for c in _ANCHOR.split(", ")]


def _at_home(k: int):
    """Blocks to their anchors, each with the positives found in its own block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch.slice(i, 1))
                for lo in range(0, len(block.ids), 512):
                    here = lo + np.flatnonzero(block.anchors[lo : lo + 512])
                    if not len(here):
                        continue
                    ids, labels, x, norms, angles = (v[here] for v in (block.ids, block.labels, block.x, block.norms, block.angles))
                    rows, columns, scores = _positives(block, ids, labels, x, norms, angles, np.full(len(here), -np.inf), k)
                    found: list[list[dict]] = [[] for _ in here]
                    for r, c, s in zip(rows.tolist(), columns.tolist(), scores.tolist()):
                        found[r].append({"id": int(block.ids[c]), "score": s})
                    pair = pa.list_(pa.struct([("id", pa.int64()), ("score", pa.int64())]))
                    keys = [f"{block.id}:{p}" for p in here.tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys, pa.string()), pa.array(ids), pa.array(labels), pa.array([v.tobytes() for v in x], pa.binary()),
                            pa.array(norms), pa.array(angles.tolist(), pa.list_(pa.float64())), pa.array([block.id] * len(here), pa.int64()),
                            pa.array(found, pair),
                        ],
                        names=[*_ANCHOR_NAMES, "found"],
                    )

    return run


def _least_angle() -> Column:
    """The angle that an anchor has at least with any row of a block."""
    apart = F.zip_with("angle_low", "angle_high", lambda low, high: F.struct(low.alias("low"), high.alias("high")))
    away = F.zip_with("angles", apart, lambda a, b: F.greatest(b["low"] - a, a - b["high"], F.lit(0.0)))
    return F.greatest(F.array_max(away) - ANGLE_ERROR, F.lit(0.0))


def _most_angle() -> Column:
    """The angle that an anchor has at most with any row of a block."""
    apart = F.zip_with("angle_low", "angle_high", lambda low, high: F.struct(low.alias("low"), high.alias("high")))

    def most(a: Column, b: Column) -> Column:
        turned = F.when(a + b["low"] >= np.pi, 2 * np.pi - a - b["low"]).otherwise(F.lit(np.pi))
        return F.when(a + b["high"] <= np.pi, a + b["high"]).otherwise(turned)

    return F.least(F.array_min(F.zip_with("angles", apart, most)) + ANGLE_ERROR, F.lit(np.pi))


def _reach(cosine: Column, upper: bool) -> Column:
    """The greatest or least score of an anchor with a block, from the cosine of its angle."""
    large, small = F.col("norm") * F.col("norm_high"), F.col("norm") * F.col("norm_low")
    slack = large * 1e-9 + 1e-6
    if upper:
        return F.when(cosine >= 0, large).otherwise(small) * cosine + slack
    return F.when(cosine >= 0, small).otherwise(large) * cosine - slack


def block_bounds() -> tuple[Column, Column]:
    """(least, greatest) score of an anchor's row with any row of a block's row."""
    least, greatest = _reach(F.cos(_most_angle()), False), _reach(F.cos(_least_angle()), True)
    return F.least(least, F.lit(_END)), F.greatest(greatest, F.lit(-_END))


def _visits(anchors: DataFrame, blocks: DataFrame, fits: Column, lanes: int, chunks: int) -> DataFrame:
    """(block, chunk) and the columns of the anchors whose bounds let them visit it.

    Anchors go to every lane of blocks, blocks to every chunk of anchors, so a task compares a bounded part of both.
    """
    summary = blocks.select(F.col("block").alias("at"), "kinds", "norm_low", "norm_high", "angle_low", "angle_high")
    left = anchors.withColumn("chunk", F.pmod(F.xxhash64("anchor"), F.lit(chunks)).cast("int")).withColumn(
        "lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))
    )
    right = summary.withColumn("_lane", F.pmod(F.xxhash64("at"), F.lit(lanes)).cast("int")).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    )
    met = left.join(right, (F.col("lane") == F.col("_lane")) & (F.col("chunk") == F.col("_chunk")) & fits)
    return met.select(F.col("at").alias("block"), "chunk", *anchors.columns)


def _meet(visits: DataFrame, blocks: DataFrame, chunks: int, score, schema: str) -> DataFrame:
    """Every block with the anchors that visit it, a chunk of these at a time."""
    there = blocks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    there = there.select("block", "chunk", "ids", "labels", "anchors", "norms", "x", "angles")
    empty = pa.schema([(f.split()[0], {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}[f.split()[1]]) for f in schema.split(", ")])

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        if not anchors.num_rows or not rows.num_rows:
            return empty.empty_table()
        block = Block(rows)
        ids, labels, norms = (anchors[c].to_numpy() for c in ("anchor_id", "label", "norm"))
        x = np.frombuffer(b"".join(anchors["x"].to_pylist()), "<f8").reshape(len(ids), -1)
        angles = np.array(anchors["angles"].to_pylist(), np.float64).reshape(len(ids), -1)
        return pa.Table.from_arrays(score(block, anchors, ids, labels, x, norms, angles), schema=empty)

    keys = ["block", "chunk"]
    return visits.groupBy(*keys).cogroup(there.groupBy(*keys)).applyInArrow(run, schema)


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low_percent: int = 80, high_percent: int = 100, scale: int = SCALE,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of rows (vec_id, label, embedding).

    An anchor's positives are its best rows of its label. Of each, the first rows of other labels come back whose
    score lies between ``low_percent`` and ``high_percent`` of the positive's.
    """
    ship(rows.sparkSession)
    blocks = index(rows, is_anchor, scale)
    home = blocks.mapInArrow(_at_home(positives), _ANCHOR.replace("anchor long", "anchor string", 1) + ", found array<struct<id: long, score: long>>")
    home = staged(home, "anchors")
    lanes = max(LANES, -(-blocks.count() // BLOCK))
    chunks = max(1, -(-home.count() // CHUNK))
    least, greatest = block_bounds()

    worst = F.when(F.size("found") >= positives, F.element_at("found", -1)["score"])
    open_ = home.withColumn("worst", worst.cast("double"))
    fits = (F.col("at") != F.col("home")) & F.array_contains("kinds", F.col("label"))
    fits &= F.col("worst").isNull() | (greatest >= F.col("worst"))
    away = _meet(
        _visits(open_.drop("found"), blocks, fits, lanes, chunks), blocks, chunks,
        _score_positives(positives), "anchor string, id long, score long",
    )
    here = home.select("anchor", F.explode("found").alias("_f")).select("anchor", "_f.id", "_f.score")
    best = _ranked(here.unionByName(away), ["anchor"], positives)
    best = staged(best.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("best")), "positives")

    # a window [low, high] of whole scores; below zero it is empty
    asked = home.drop("found").join(best, "anchor")
    usable = F.filter("best", lambda p: p["score"] >= 0)
    asked = asked.withColumn("best", usable).filter(F.size("best") > 0)
    scores = F.transform("best", lambda p: p["score"].cast("double"))
    fits = (F.size("kinds") > 1) | (F.element_at("kinds", 1) != F.col("label"))
    fits &= greatest >= F.array_min(scores) * (low_percent / 100) * (1 - 1e-9) - 1
    fits &= least <= F.array_max(scores) * (high_percent / 100) * (1 + 1e-9) + 1
    found = _meet(
        _visits(asked, blocks, fits, lanes, chunks), blocks, chunks, _score_negatives(negatives, low_percent, high_percent),
        "anchor string, anchor_id long, positive_id long, positive_rank int, positive_score long, id long, score long",
    )
    first = _ranked(found, ["anchor", "positive_rank"], negatives)
    return first.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def _score_positives(k: int):
    def score(block, anchors, ids, labels, x, norms, angles) -> list[pa.Array]:
        worst = anchors["worst"].to_numpy().astype(float)
        worst = np.nextafter(np.where(np.isnan(worst), -np.inf, worst), -np.inf)  # a double may round a long
        rows, columns, scores = _positives(block, ids, labels, x, norms, angles, worst, k)
        names = anchors["anchor"].to_pylist()
        return [pa.array([names[r] for r in rows.tolist()], pa.string()), pa.array(block.ids[columns]), pa.array(scores)]

    return score


def _score_negatives(k: int, low_percent: int, high_percent: int):
    def window(score: int) -> tuple[int, int]:
        return min(-(-low_percent * score // 100), _LONG.max), min(high_percent * score // 100, _LONG.max)

    def score(block, anchors, ids, labels, x, norms, angles) -> list[pa.Array]:
        best = anchors["best"].to_pylist()
        windows = [[window(p["score"]) for p in ps] for ps in best]
        rows, which, columns, scores = _negatives(block, ids, labels, x, norms, angles, windows, k)
        names = anchors["anchor"].to_pylist()
        positives = [best[r][w] for r, w in zip(rows.tolist(), which.tolist())]
        return [
            pa.array([names[r] for r in rows.tolist()], pa.string()), pa.array(ids[rows]),
            pa.array([p["id"] for p in positives], pa.int64()), pa.array([p["rank"] for p in positives], pa.int32()),
            pa.array([p["score"] for p in positives], pa.int64()), pa.array(block.ids[columns]), pa.array(scores),
        ]

    return score


def query(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)
