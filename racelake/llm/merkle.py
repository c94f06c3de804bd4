"""Merkle manifest of a dataset in a van Emde Boas layout.

Every row is a leaf, the SHA-256 of its columns. Per source the leaves, in the order of doc_id, form a tree in
which ``FANOUT`` consecutive nodes (the last run may be shorter) become their parent; the subroots, in the order
of their source, form the tree of the root the same way.

A tree is stored as aligned subtrees of ``HEIGHT`` steps, one row each. Inside a subtree the nodes lie in van
Emde Boas order: the upper half of the levels first, then every lower subtree one after the other, and the same
again inside each. ``address`` computes the place of a node by arithmetic alone; construction writes and the
retrieval of siblings reads through it. The roots of the subtrees are the leaves of the next round, so a tree
of n leaves takes log(n) / log(FANOUT ** HEIGHT) rounds, and no task holds more than one subtree at a time.

Ranks come from sorted ranges and the number of rows before each range, so a source may hold any share of the
rows.

Cases: a null in any column is a leaf's ``-``; a null source is a source of its own, before the others; null
doc_ids come first, rows of one doc_id (repeated ones as well) are in the order of their leaf, each a leaf of its own;
a lone leaf is its own subroot, a lone subroot the root; without siblings a proof is empty; further
columns are ignored; an empty table gives an empty manifest.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from racelake.llm.staging import documents, staged
from racelake.shipping import ship

FANOUT = 16
HEIGHT = 3
SPAN = FANOUT**HEIGHT
"""leaves of a stored subtree"""
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
DIGEST = 32

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


# --- layout of one subtree ---


def nodes_in(levels: int) -> int:
    """Nodes of a complete tree of so many levels."""
    return (FANOUT**levels - 1) // (FANOUT - 1)


def address(levels: int, depth: int, i):
    """Place of the i-th node (or of an array of nodes) at a depth, in van Emde Boas order."""
    at = 0
    while depth:
        top = levels // 2
        if depth < top:
            levels = top
            continue
        below = FANOUT ** (depth - top)
        at = at + nodes_in(top) + i // below * nodes_in(levels - top)
        levels, depth, i = levels - top, depth - top, i % below
    return at


def height_of(size: int) -> int:
    """Steps from so many leaves to one node."""
    steps = 0
    while size > 1:
        size, steps = -(-size // FANOUT), steps + 1
    return steps


def parent(digests: Sequence[bytes]) -> bytes:
    """The node above some digests: the hash of their hexadecimal text."""
    return sha256(b"".join(d.hex().encode() for d in digests)).digest()


def build(leaves: Sequence[bytes], levels: int) -> bytes:
    """The nodes of a subtree in their layout; places without a node are zero."""
    nodes = np.zeros((nodes_in(levels), DIGEST), np.uint8)
    row = list(leaves)
    for depth in range(levels - 1, -1, -1):
        nodes[address(levels, depth, np.arange(len(row))) + np.zeros(len(row), int)] = np.frombuffer(b"".join(row), np.uint8).reshape(-1, DIGEST)
        if depth:
            row = [parent(row[i : i + FANOUT]) for i in range(0, len(row), FANOUT)]
    return nodes.tobytes()


def siblings(nodes: bytes, levels: int, size: int, i: int) -> tuple[bytes, list[int], list[int]]:
    """Of the i-th leaf: the siblings' digests from the leaves up, their number and the leaf's place per level."""
    found, counts, places = [], [], []
    for depth in range(levels - 1, 0, -1):
        first = i // FANOUT * FANOUT
        run = range(first, min(first + FANOUT, size))
        others = [address(levels, depth, j) * DIGEST for j in run if j != i]
        found += [nodes[at : at + DIGEST] for at in others]
        counts.append(len(others))
        places.append(i - first)
        i, size = i // FANOUT, -(-size // FANOUT)
    return b"".join(found), counts, places


def all_siblings(nodes: bytes, levels: int, size: int) -> list[tuple[bytes, list[int], list[int]]]:
    """``siblings`` of every leaf; what leaves share above them is put together once."""
    sizes = [size]
    for _ in range(levels - 1):
        sizes.append(-(-sizes[-1] // FANOUT))
    grid = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST)
    found: list[tuple[bytes, list[int], list[int]]] = [(b"", [], [])]
    for depth, n in zip(range(1, levels), sizes[-2::-1]):
        row, lower = grid[address(levels, depth, np.arange(n))].tobytes(), []
        for i in range(n):
            first = i // FANOUT * FANOUT
            end, above = min(first + FANOUT, n), found[i // FANOUT]
            own = row[first * DIGEST : i * DIGEST] + row[(i + 1) * DIGEST : end * DIGEST]
            lower.append((own + above[0], [end - first - 1, *above[1]], [i - first, *above[2]]))
        found = lower
    return found


def fold(leaf: bytes, found: bytes, counts: Sequence[int], places: Sequence[int]) -> bytes:
    """The root that a leaf and its siblings, level by level, lead to."""
    at = 0
    for count, place in zip(counts, places):
        run = [found[at + k * DIGEST : at + (k + 1) * DIGEST] for k in range(count)]
        leaf = parent([*run[:place], leaf, *run[place:]])
        at += count * DIGEST
    return leaf


# --- leaves ---


def leaf_digest(columns: Sequence[Column]) -> Column:
    """SHA-256 (32 bytes) of values written as ``length:value``, nulls as ``-``."""
    values = (c.cast("string") for c in columns)
    parts = (F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values)
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _key(source: Column) -> Column:
    """A source as a text that is never null, in the sources' order."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


# --- distributed construction ---


def ranked(rows: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``rows`` (with ``key``) and ``at``, their place within their key, and ``n``, the key's number of rows.

    The rows are dealt out in sorted ranges; per key and range one row of counts tells where it begins.
    """
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = ["key", *order, "_tie"]  # the tie keeps rows that are the same apart, so that a range can end among them
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(ranges, *by).sortWithinPartitions(*by)
    numbered = staged(dealt.drop("_tie").withColumn("_row", F.monotonically_increasing_id()), name)
    numbered = numbered.withColumn("_range", F.shiftright("_row", 33))
    spans = numbered.groupBy("key", "_range").agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        "key", "_range", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy("key")).alias("n"),
    )
    placed = numbered.join(spans, ["key", "_range"])
    return placed.withColumn("at", F.col("_row") + F.col("_shift")).drop("_row", "_range", "_shift")


def _blocks(leaves: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Rows (key, at, n, digest) as subtrees: (key, block, n, members in order)."""
    member = F.struct((F.col("at") % SPAN).cast("int").alias("slot"), "digest", *carried)
    grouped = leaves.withColumn("block", F.expr(f"at div {SPAN}")).groupBy("key", "block", "n")
    return grouped.agg(F.array_sort(F.collect_list(member)).alias("members"))


def _levels(n: int, size: int) -> int:
    """Levels of a subtree: all of them, unless the tree ends within it."""
    return (height_of(size) if n <= SPAN else HEIGHT) + 1


def _with_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):  # a subtree at a time
            row = batch.slice(i, 1)
            leaves = row.column("members").flatten().field("digest").to_pylist()
            nodes = build(leaves, _levels(row.column("n")[0].as_py(), len(leaves)))
            yield pa.RecordBatch.from_arrays(
                [*row.columns, pa.array([nodes], pa.binary()), pa.array([nodes[:DIGEST]], pa.binary())],
                names=[*row.schema.names, "nodes", "root"],
            )


def _stored(blocks: DataFrame, name: str) -> DataFrame:
    schema = StructType(list(blocks.schema)).add("nodes", "binary").add("root", "binary")
    return staged(blocks.mapInArrow(_with_nodes, schema), name)


class Manifest(NamedTuple):
    """Stored subtrees: by source, a table per round from the leaves up, and the same for the tree of subroots."""

    sources: list[DataFrame]
    subroots: list[DataFrame]


def _grow(leaves: DataFrame, name: str, carried: Sequence[str] = ()) -> list[DataFrame]:
    """All rounds of some trees (key, at, n, digest), from the leaves to the roots."""
    rounds = [_stored(_blocks(leaves, carried), f"{name}-0")]
    while True:
        # a tree that fits one subtree is complete
        upper = rounds[-1].filter(F.col("n") > SPAN).select(
            "key", F.col("block").alias("at"), F.ceil(F.col("n") / SPAN).cast("long").alias("n"), F.col("root").alias("digest")
        )
        if upper.isEmpty():
            return rounds
        rounds.append(_stored(_blocks(upper), f"{name}-{len(rounds)}"))


def _roots(rounds: Sequence[DataFrame]) -> DataFrame:
    """(key, root) of complete trees."""
    done = [r.filter(F.col("n") <= SPAN).select("key", "root") for r in rounds]
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def build_manifest(docs: DataFrame, tampered: Column | None = None) -> Manifest:
    """The manifest of ``docs``.

    With ``tampered``, a condition, rows for which it holds also carry the leaf they would have if the letters A-Z
    of their text were lower case, for a proof that must fail.
    """
    ship(docs.sparkSession)
    values = [F.col(c) for c in COLUMNS]
    lowered = F.translate("text", _UPPER, _UPPER.lower())
    other = F.lit(None).cast("binary")
    if tampered is not None:
        other = F.when(tampered, leaf_digest([*values[:-1], lowered]))
    leaves = docs.select(
        _key(F.col("source")).alias("key"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf_digest(values).alias("digest"), other.alias("tampered"),
    )
    leaves = ranked(staged(leaves, "merkle-leaves"), ["doc_id", "digest"], "merkle-order")
    sources = _grow(leaves, "merkle-source", ["doc_id", "tampered"])
    subroots = _roots(sources).select(F.lit("").alias("key"), F.col("key").alias("source_key"), F.col("root").alias("digest"))
    subroots = ranked(staged(subroots, "merkle-subroots"), ["source_key"], "merkle-subroot-order")
    return Manifest(sources, _grow(subroots, "merkle-root", ["source_key"]))


# --- proofs ---

_PATH = "siblings binary, counts array<int>, places array<int>"


def _paths(blocks: DataFrame, carried: dict[str, str]) -> DataFrame:
    """Rows (key, at, path) of all leaves of subtrees with ``siblings``, ``counts``, ``places`` of their own root."""
    names = list(carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                members = row.column("members").flatten()
                size, n = len(members), row.column("n")[0].as_py()
                nodes, levels = row.column("nodes")[0].as_py(), _levels(n, size)
                above, counts, places = (row.column(c)[0].as_py() for c in ("siblings", "counts", "places"))
                key, first = row.column("key")[0].as_py(), row.column("block")[0].as_py() * SPAN
                found = all_siblings(nodes, levels, size)
                for lo in range(0, size, 256):
                    hi = min(lo + 256, size)
                    own = found[lo:hi]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([key] * (hi - lo), pa.string()), pa.array(range(first + lo, first + hi), pa.int64()),
                            pa.array([o[0] + above for o in own], pa.binary()),
                            pa.array([o[1] + counts for o in own], pa.list_(pa.int32())),
                            pa.array([o[2] + places for o in own], pa.list_(pa.int32())),
                            *(members.field(c).slice(lo, hi - lo) for c in names),
                        ],
                        names=["key", "at", "siblings", "counts", "places", *names],
                    )

    extra = "".join(f", {c} {kind}" for c, kind in carried.items())
    columns = blocks.select("key", "block", "n", "members", "nodes", "siblings", "counts", "places")
    return columns.mapInArrow(run, f"key string, at long, {_PATH}{extra}")


def _descend(rounds: Sequence[DataFrame], tops: DataFrame | None, carried: dict[str, str]) -> DataFrame:
    """The paths of all leaves, from the last round to the first; ``tops`` are the paths of the trees' roots."""
    nothing = (F.lit(b"").alias("siblings"), F.array().cast("array<int>").alias("counts"), F.array().cast("array<int>").alias("places"))
    found = None
    for i in range(len(rounds) - 1, -1, -1):
        blocks = rounds[i]
        done = blocks.filter(F.col("n") <= SPAN)
        done = done.select("*", *nothing) if tops is None else done.join(tops, "key")
        if found is not None:  # subtrees below those of the round above
            below = blocks.filter(F.col("n") > SPAN).join(found.withColumnRenamed("at", "block"), ["key", "block"])
            done = done.unionByName(below)
        found = _paths(done, carried if i == 0 else {})
    return found


def prove(manifest: Manifest) -> DataFrame:
    """Every leaf with its siblings: (key, at, doc_id, digest, tampered, siblings, counts, places, subroot, root).

    ``siblings`` are 32-byte digests from the leaf's run to the root's, left to right; ``counts`` says how many
    belong to each level, ``places`` where the leaf's own node stands among them.
    """
    tops = _descend(manifest.subroots, None, {"source_key": "string"}).drop("key", "at").withColumnRenamed("source_key", "key")
    leaves = _descend(manifest.sources, tops, {"doc_id": "long", "digest": "binary", "tampered": "binary"})
    roots = _roots(manifest.sources).withColumnRenamed("root", "subroot")
    whole = _roots(manifest.subroots).select("root")
    root = whole.select(F.lit(True).alias("_all"), "root")
    return leaves.join(roots, "key").withColumn("_all", F.lit(True)).join(root, "_all").drop("_all")


def verify(proofs: DataFrame) -> DataFrame:
    """Proofs with ``folded``, the root that the tampered leaf, else the leaf, leads to, and ``verified``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ("digest", "tampered", "siblings", "counts", "places", "root")
            rows = zip(*(batch.column(c).to_pylist() for c in names))
            folded = [(fold(d if t is None else t, s, c, p), r) for d, t, s, c, p, r in rows]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f for f, _ in folded], pa.binary()), pa.array([f == r for f, r in folded], pa.bool_())],
                names=[*batch.schema.names, "folded", "verified"],
            )

    return proofs.mapInArrow(run, StructType(list(proofs.schema)).add("folded", "binary").add("verified", "boolean"))


def query(spark: SparkSession, folder: str) -> DataFrame:
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    proofs = verify(prove(build_manifest(documents(spark, folder), chosen)))

    def digest(c: str) -> Column:
        return F.lower(F.hex(c))

    return proofs.select(
        "doc_id", digest("digest").alias("leaf"), digest("subroot").alias("subroot"), digest("root").alias("root"),
        F.sha2(F.encode(digest("siblings"), "UTF-8"), 256).alias("proof_sha256"), digest("folded").alias("folded_root"), "verified",
    )
