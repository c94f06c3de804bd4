"""Similarity join on word shingles by token-combination prefixes, and its connected groups.

Texts with equal shingle sets are one node. Tokens (shingles) are ordered by a class of their frequency,
rare ones first. Two sets that are similar enough share a token in their prefixes, the first
``n - least overlap + 1`` tokens of each. If the first token they share is rare, that token indexes both.
If not, all they share is frequent: their prefixes, extended by ``CLASSES`` tokens, share more tokens than
there are hash classes, so two of these fall into the same class. Pairs of frequent tokens of
one class are therefore the index of frequent tokens. Sets too small for the extension are indexed by every
prefix token; sets that can be similar to such a small one are indexed both ways.

Nodes found under one index entry are compared with one of them, the hub, first: with the smallest set, the largest one,
and then, under large entries and as long as that finds links, with hubs drawn anew in every round, of which a node takes
the one most like it. Comparing joins most copies of a group to one component, also where many of its pairs are just below
the threshold; what remains are pairs of nodes in different components, compared one by one, where parities of their
tokens do not rule them out within the join. So every pair of nodes is either compared, or in one component already, or
impossible by length or position.

Frequencies come from a count sketch of fixed size over all texts. A sketch can only overestimate, which
changes the order of tokens but no result: any order that all texts share is right.

Cases: null or empty texts, and those without words, have an empty set and are linked with nothing;
repeated rows are one node and get the same component; ties of order are broken by the hash; rows with a
null doc_id take part, a component's id is the smallest doc_id that is not null; further columns are ignored; an empty table
gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.llm.shingles import mix, shingle_set, word_hashes
from racelake.llm.staging import documents, free_name, staged, tidy
from racelake.shipping import ship

CLASSES = 16
SKETCH = 1 << 20
"""counters of the frequency sketch; 8 bytes each go to the driver and back"""
RARE = 64
"""a token of this count is rare at every size of the corpus; the sketch cannot tell a little more, see frequency_class"""
PARITIES = 1024
MARKS = 1 << 26
"""bits of the bitmap that marks rows whose sets are wanted"""
TURNS = 8
"""rounds at most: one with the largest set as hub, then drawn hubs, then all pairs that are left"""
LARGE = 8
"""nodes up to which all open pairs of an entry are compared without rounds of drawn hubs"""
WORTH = 0.02
"""links per open node of large entries that a round of drawn hubs finds if another one is worth it"""
PARTS = 16
"""rows the sketch is summed up in"""
_BATCH = 256


def least_overlap(n, percent: int):
    """The fewest tokens a set of n shares with any set that is similar enough."""
    return -(-n * percent // 100)


def _sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    for words in word_hashes([t or "" for t in texts.to_pylist()]):
        yield shingle_set(words, k)


def _node(tokens: np.ndarray) -> int:
    """A 64-bit name of a set; null (None) for the empty one."""
    if not len(tokens):
        return None
    return int(np.bitwise_xor.reduce(mix(tokens + np.uint64(len(tokens)))).view(np.int64))


def _parities(tokens: np.ndarray) -> np.ndarray:
    """Per hash class, whether a set holds an odd number of its tokens; as 64-bit words.

    Every class in which two sets differ holds a token that only one of them has.
    """
    odd = np.bincount((mix(tokens + np.uint64(7)) % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _fine_parities(tokens: np.ndarray) -> np.ndarray:
    """Parities of two to four times as many classes as tokens, a power of two: sets of any size can be told apart by them."""
    classes = max(PARITIES, 1 << (2 * len(tokens) - 1).bit_length())
    odd = np.bincount((mix(tokens + np.uint64(11)) & np.uint64(classes - 1)).astype(np.int64), minlength=classes) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _describe(k: int):
    """Rows to (doc_id, row_key, n, node, odd), and a partial sketch per task: (part, counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(SKETCH, np.int64)
        names = ["doc_id", "row_key", "n", "node", "odd", "part", "counts"]
        words = pa.list_(pa.int64())
        for batch in batches:
            for lo in range(0, batch.num_rows, _BATCH):
                rows = batch.slice(lo, _BATCH)
                sizes, nodes, odd, seen = [], [], [], []
                for tokens in _sets(rows.column("text"), k):
                    sizes.append(len(tokens))
                    nodes.append(_node(tokens))
                    odd.append(_parities(tokens))
                    seen.append(tokens)
                sketch += np.bincount((np.concatenate(seen) % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), rows.column("row_key"), pa.array(sizes, pa.int32()), pa.array(nodes, pa.int64()), pa.array(odd, words), pa.nulls(len(sizes), pa.int32()), pa.nulls(len(sizes), pa.binary())],
                    names=names,
                )
        if sketch.any():
            counts = [p.astype(np.uint32).tobytes() for p in np.split(sketch, PARTS)]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(PARTS, pa.int64()), pa.nulls(PARTS, pa.int64()), pa.nulls(PARTS, pa.int32()), pa.nulls(PARTS, pa.int64()), pa.nulls(PARTS, words), pa.array(range(PARTS), pa.int32()), pa.array(counts, pa.binary())],
                names=names,
            )

    return run


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sketches to one row per part of this task; memory is one sketch."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts")):
            sums[part] = sums.get(part, 0) + np.frombuffer(counts.as_buffer(), np.uint32).astype(np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(sums, pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["part", "counts"]
    )


def frequency_class(sketch: np.ndarray) -> np.ndarray:
    """Per counter 0 for rare tokens, else 1 and up by powers of two of the tokens over what the others give a counter.

    A counter holds about ``level`` of other tokens, give or take its root. What goes beyond eight roots and ``RARE`` is a
    token's own count: the bound hardly rises with the corpus.
    """
    level = float(np.median(sketch))
    own, bound = np.maximum(sketch - level, 1), RARE + 8 * level**0.5
    return np.where(own > bound, 1 + np.log2(np.maximum(own / bound, 1)).astype(np.int64), 0).astype(np.uint64)


def signatures(tokens: np.ndarray, classes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index entries of a set and the place of the token behind each (-1 for pairs of tokens)."""
    n = len(tokens)
    rank = classes[(tokens % np.uint64(SKETCH)).astype(np.int64)]
    order = np.lexsort((mix(tokens), rank))
    tokens, rank = tokens[order], rank[order]
    overlap = least_overlap(n, percent)
    prefix = n - overlap + 1
    rare = rank[:prefix] == 0
    extended = overlap > CLASSES
    # the smallest partner of this set has this many tokens
    singles = np.ones(prefix, bool) if least_overlap(overlap, percent) <= CLASSES else rare
    own = mix(tokens[:prefix][singles])
    places = np.flatnonzero(singles)
    if not extended or rank[min(n, prefix + CLASSES) - 1] == 0:
        return own, places
    frequent = tokens[: prefix + CLASSES][rank[: prefix + CLASSES] > 0]
    pairs = []
    group = (mix(frequent + np.uint64(1)) % np.uint64(CLASSES)).astype(np.int64)
    for g in range(CLASSES):
        same = frequent[group == g]
        a, b = np.triu_indices(len(same), 1)
        pairs.append(mix(np.minimum(same[a], same[b]) * np.uint64(3) + mix(np.maximum(same[a], same[b]))))
    pairs = np.concatenate(pairs)
    return np.concatenate([own, pairs]), np.concatenate([places, np.full(len(pairs), -1)])


def _index(k: int, percent: int, shared):
    """Texts to (sig, n, node, place), each set of a batch once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = shared.value
        for batch in batches:
            done: set[int] = set()
            for lo in range(0, batch.num_rows, _BATCH):
                sigs, sizes, nodes, places = [], [], [], []
                for tokens in _sets(batch.slice(lo, _BATCH).column("text"), k):
                    node = _node(tokens)
                    if node is None or node in done:
                        continue
                    done.add(node)
                    own, at = signatures(tokens, classes, percent)
                    sigs.append(own)
                    places.append(at)
                    sizes.append(np.full(len(own), len(tokens)))
                    nodes.append(np.full(len(own), node))
                if sigs:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(sizes).astype(np.int32)),
                            pa.array(np.concatenate(nodes).astype(np.int64)), pa.array(np.concatenate(places).astype(np.int32)),
                        ],
                        names=["sig", "n", "node", "place"],
                    )

    return run


def _tokens_of(k: int, shared):
    """Rows (row_key, text) whose key is marked in the bitmap to (node, n, fine, tokens)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        for batch in batches:
            bit = batch.column("row_key").to_numpy().view(np.uint64) % np.uint64(MARKS)
            marked = bitmap[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1) > 0
            batch = batch.filter(pa.array(marked))
            for lo in range(0, batch.num_rows, _BATCH):
                sets = [s for s in _sets(batch.slice(lo, _BATCH).column("text"), k) if len(s)]
                words = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_node(s) for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int32()),
                        pa.array([_fine_parities(s) for s in sets], words), pa.array([s.view(np.int64) for s in sets], words),
                    ],
                    names=["node", "n", "fine", "tokens"],
                )

    return run


def _sets_of(pairs: DataFrame, node_rows: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """(node, n, fine, tokens) of the nodes of pairs, and of a few others, made from their texts.

    The texts are read once more, but not moved: a bitmap of fixed size marks the rows to look at. Where
    more rows are wanted than it has bits, more sets are made than needed; the join with the pairs drops them.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    bit = F.pmod(F.col("row_key"), F.lit(MARKS))
    # the row key as an unsigned number modulo a power of two is the same as pmod of the signed one
    words = (
        node_rows.join(wanted, "node").select(bit.alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits")).collect()
    )
    bitmap = np.zeros(MARKS // 64, np.uint64)
    for r in words:
        bitmap[r["word"]] = np.int64(r["bits"]).view(np.uint64)
    shared = rows.sparkSession.sparkContext.broadcast(bitmap)
    found = rows.select("row_key", "text").mapInArrow(tidy(_tokens_of(k, shared)), "node long, n int, fine array<long>, tokens array<long>")
    return staged(found, "shared-sets")


def _repeated_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (sig, n, node): those under an entry that holds two nodes or more, each once, and whether it holds just two.

    Reads along; what is held back is one batch and, of the entry at its end, nothing but one row. An entry that goes
    beyond its batch is not said to hold just two.
    """

    def marked(rows: pa.RecordBatch, two: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array(two)], names=[*rows.schema.names, "two"])

    held: pa.RecordBatch | None = None  # the first row of an entry that may yet turn out to be shared
    last: tuple[int, int] | None = None
    for batch in batches:
        sig, node = (batch.column(c).to_numpy() for c in ("sig", "node"))
        if not len(sig):
            continue
        same_sig = np.concatenate([[last is not None and sig[0] == last[0]], sig[1:] == sig[:-1]])
        copy = same_sig & np.concatenate([[last is not None and node[0] == last[1]], node[1:] == node[:-1]])
        joins = same_sig & ~copy  # another node under the entry of the row before
        entry = np.cumsum(~same_sig)  # 0: goes on from the batch before
        others = np.bincount(entry, weights=joins, minlength=entry[-1] + 1)
        counted = others > 0
        two = (others == 1)[entry] & (entry > 0) & (entry < entry[-1])
        keep = counted[entry] & ~copy
        carried = entry[0] == 0
        if carried and held is not None and counted[0]:
            yield marked(held, np.zeros(1, bool))
            held = None
        if carried and held is None:
            keep |= (entry == 0) & ~copy  # its entry was shared already
        if entry[-1] > 0:
            first = int(np.flatnonzero(~same_sig)[-1])
            held = None if counted[entry[-1]] else batch.slice(first, 1)
        last = int(sig[-1]), int(node[-1])
        if keep.any():
            yield marked(batch.filter(pa.array(keep)), two[keep])


def _possible(a_n: Column, b_n: Column, a_place: Column, b_place: Column, percent: int) -> Column:
    """Whether lengths, and places of what may be the first shared token, allow enough overlap."""
    overlap = F.ceil((a_n + b_n) * percent / (100 + percent))
    left = F.least(a_n - a_place, b_n - b_place)
    return (F.least(a_n, b_n) * 100 >= F.greatest(a_n, b_n) * percent) & ((a_place < 0) | (b_place < 0) | (left >= overlap))


def _most_apart(both: Column, percent: int) -> Column:
    """In how many tokens similar enough sets with ``both`` tokens in total can differ."""
    return both - 2 * F.ceil(both * percent / (100 + percent))


def _apart(a: str, b: str) -> Column:
    """In how many parities two rows differ."""
    return reduce(Column.__add__, (F.bit_count(F.col(f"{a}odd_{i}").bitwiseXOR(F.col(f"{b}odd_{i}"))) for i in range(PARITIES // 64)))


def _close(pairs: DataFrame, node_rows: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose parities do not rule out that they are similar enough."""
    for side in ("a", "b"):
        facts = node_rows.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("odd").alias(f"odd_{side}"))
        pairs = pairs.join(facts, side)
    both = F.col("n_a") + F.col("n_b")
    apart = F.aggregate(F.zip_with("odd_a", "odd_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return pairs.filter(apart <= _most_apart(both, percent)).select("a", "b")


def _likely(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose fine parities, folded to the same number of classes, allow that they are similar enough."""
    for side in ("a", "b"):
        facts = sets.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("fine").alias(f"fine_{side}"))
        pairs = pairs.join(facts, side)
    words = F.least(F.size("fine_a"), F.size("fine_b"))

    def folded(fine: str) -> Column:
        # sets that can be similar differ by one doubling at most
        halves = F.zip_with(F.slice(fine, F.lit(1), words), F.slice(fine, words + 1, words), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(fine) == 2 * words, halves).otherwise(F.col(fine))

    apart = F.aggregate(F.zip_with(folded("fine_a"), folded("fine_b"), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    # repeated rows give a set twice
    return pairs.filter(apart <= _most_apart(F.col("n_a") + F.col("n_b"), percent)).select("a", "b").distinct()


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough; only sets of likely pairs are moved."""
    pairs = staged(_likely(pairs, sets, percent), "likely-pairs")
    sets = sets.join(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "node", "left_semi")
    a = sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    b = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    union = F.size("ta") + F.size("tb") - both
    return pairs.join(a, "a").join(b, "b").filter(both * 100 >= union * percent).select("a", "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, label) of the nodes of links (a, b); the label is the smallest node that can be reached.

    Every round takes the smallest label of the neighbours, then the label of the label, so that a chain
    shrinks by more than half each time.
    """
    edges = staged(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = staged(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("a"), "label"), "a").groupBy(F.col("b").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        moved = staged(lower.join(jump, "next", "left").select("node", "label", F.least("next", "far").alias("next")), "labels")
        changed = moved.filter("label != next").limit(1).count()
        labels = moved.select("node", F.col("next").alias("label"))
        if not changed:
            return labels


def _hub_pairs(entries: DataFrame, hub: Column, percent: int) -> DataFrame:
    """Every row of an entry with the entry's hub; rows have sig, n, node, place."""
    hubs = entries.groupBy("sig").agg(hub.alias("hub"))
    rows = entries.join(hubs, "sig").filter(F.col("node") != F.col("hub.node"))
    rows = rows.filter(_possible(F.col("n"), F.col("hub.n"), F.col("place"), F.col("hub.place"), percent))
    return rows.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct()


def _sided(rows: DataFrame, side: str) -> DataFrame:
    return rows.select("sig", *(F.col(c).alias(f"{side}_{c}") for c in rows.columns if c != "sig"))


def _open(percent: int) -> Column:
    """Whether rows a and b of an entry are in different components and their parities, lengths and places allow a link.

    All conditions are on the two rows, so Spark tests them in the join, which gives likely pairs only.
    """
    alike = _apart("a_", "b_") <= _most_apart(F.col("a_n") + F.col("b_n"), percent)
    return (F.col("a_label") != F.col("b_label")) & alike & _possible(F.col("a_n"), F.col("b_n"), F.col("a_place"), F.col("b_place"), percent)


def _nearest_hubs(entries: DataFrame, odds: DataFrame, turn: int, percent: int) -> DataFrame:
    """Every row of an entry meets one row drawn from it; of all it meets, a node keeps the one whose parities differ least.

    A node stands under many entries, so it meets many rows of its group, and a group's components join quickly. What the
    draw misses is found by the last turn, which takes all pairs.
    """
    drawn = entries.withColumn("drawn", F.xxhash64("sig", "node", F.lit(turn)))
    hubs = drawn.join(drawn.groupBy("sig").agg(F.min("drawn").alias("_least")), "sig").filter("drawn = _least").drop("drawn", "_least")
    met = _sided(entries.join(odds, "node"), "a").join(_sided(hubs.join(odds, "node"), "b"), "sig").filter(_open(percent))
    nearest = met.groupBy("a_node").agg(F.min(F.struct(_apart("a_", "b_").alias("apart"), F.col("b_node"))).alias("hub"))
    return nearest.select(F.least("a_node", "hub.b_node").alias("a"), F.greatest("a_node", "hub.b_node").alias("b")).distinct()


def _likely_pairs(entries: DataFrame, odds: DataFrame, percent: int) -> DataFrame:
    """All pairs of rows of an entry that are still open."""
    sides = entries.join(odds, "node")
    found = _sided(sides, "a").join(_sided(sides, "b"), "sig").filter((F.col("a_node") < F.col("b_node")) & _open(percent))
    return found.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")).distinct()


def _row_key() -> Column:
    """A key by which equal rows (doc_id, text), and practically only these, are the same."""
    return F.xxhash64(F.col("doc_id").cast("long"), "text")


def join(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(doc_id, row_key, n_shingles, component, component_id) of every row of ``docs`` (doc_id, text).

    ``component`` names the group and is null for empty sets, ``component_id`` is its smallest doc_id.
    """
    spark = ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row_key().alias("row_key"), "text")
    shape = "doc_id long, row_key long, n int, node long, odd array<long>, part int, counts binary"
    described = staged(rows.mapInArrow(tidy(_describe(k)), shape), "shingle-nodes")
    nodes = described.filter("part is null").select("doc_id", "row_key", "n", "node")
    partial = described.filter("part is not null").select("part", "counts")
    summed = partial.repartition(PARTS, "part").mapInArrow(_add_up, "part int, counts binary").collect()
    sketch = np.zeros(SKETCH, np.int64)
    for r in summed:
        sketch.reshape(PARTS, -1)[r["part"]] += np.frombuffer(r["counts"], np.int64)
    classes = spark.sparkContext.broadcast(frequency_class(sketch))

    index = rows.select("text").mapInArrow(tidy(_index(k, percent, classes)), "sig long, n int, node long, place int")
    ordered = index.repartition(F.col("sig")).sortWithinPartitions("sig", "n", "node")
    shared = staged(ordered.mapInArrow(tidy(_repeated_entries), "sig long, n int, node long, place int, two boolean"), "shared-entries")
    entries = shared.drop("two")

    described_nodes = described.filter("n > 0").groupBy("node")
    node_rows = staged(
        described_nodes.agg(F.min("row_key").alias("row_key"), F.first("n").alias("n"), F.first("odd").alias("odd")), "node-rows"
    )

    def linked(pairs: DataFrame, close: bool = False) -> DataFrame:
        pairs = pairs if close else staged(_close(pairs, node_rows, percent), "close-pairs")
        return staged(_linked(pairs, _sets_of(pairs, node_rows, rows, k), percent), "links")

    tested = staged(_hub_pairs(entries, F.min(F.struct("n", "node", "place")), percent), "pairs")
    links = linked(tested)
    gained = None  # by the last round of drawn hubs
    entries = shared.filter("not two").drop("two")  # two nodes have been compared
    for turn in range(1, TURNS + 1):
        labels = components(links)
        labelled = entries.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        counts = labelled.groupBy("sig", "label").agg(F.count("*").alias("_rows"))
        spans = counts.groupBy("sig").agg(F.count("*").alias("_labels"), F.sum("_rows").alias("_size"))
        # a hub is compared with all of its entry: two nodes are done after one turn, three after two
        mixed = spans.filter((F.col("_labels") > 1) & (F.col("_size") > (2 if turn == 1 else 3))).select("sig", (F.col("_size") > LARGE).alias("large"))
        open_entries = staged(labelled.join(mixed, "sig"), "open-entries")
        entries = open_entries.select(*entries.columns)  # components only grow: an entry that is done stays done
        last = turn == TURNS
        if turn == 1:
            found = _hub_pairs(open_entries.drop("label", "large"), F.max(F.struct("n", "node", "place")), percent)
        else:
            large = open_entries.filter("large")
            opened = large.agg(F.count_distinct("node")).first()[0]
            last = last or not opened or gained is not None and gained < WORTH * opened
            odds = node_rows.select("node", *(F.get("odd", F.lit(i)).alias(f"odd_{i}") for i in range(PARITIES // 64)))
            found = _likely_pairs(open_entries, odds, percent) if last else _nearest_hubs(large, odds, turn, percent)
        pairs = staged(found.join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = tested.unionByName(pairs)
        new = linked(pairs, close=turn > 1)
        links = links.unionByName(new)
        if last:
            break
        gained = new.count() if turn > 1 else None
    labels = components(links)
    named_nodes = nodes.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    of_node = named_nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    of_label = of_node.groupBy("label").agg(F.min("least").alias("component_id"))
    of_node = of_node.join(of_label, "label").select(F.col("node").alias("_node"), "label", "component_id")
    return nodes.join(of_node, F.col("node") == F.col("_node"), "left").select(
        "doc_id", "row_key", F.col("n").cast("long").alias("n_shingles"), F.col("label").alias("component"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def survivors(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """One row of every group of ``docs``, the one with the smallest doc_id, with all its columns.

    Rows without words are in no group and all stay; a row without doc_id only stands for a group that has no other.
    """
    found = join(docs, k, percent)
    grouped = found.filter("component is not null")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key")).alias("first")
    kept = grouped.groupBy("component").agg(first).select("first.doc_id", "first.row_key")
    kept = kept.unionByName(found.filter("component is null").select("doc_id", "row_key").distinct())
    number, chosen, own = (free_name(docs.columns, n) for n in ("_kept_id", "_kept_key", "_row_key"))
    kept = staged(kept.select(F.col("doc_id").alias(number), F.col("row_key").alias(chosen)), "survivors")
    rows = docs.withColumn(own, _row_key())
    same = (F.col(own) == F.col(chosen)) & F.col("doc_id").cast("long").eqNullSafe(F.col(number))
    # copies of a row are one document: of the same key one row stays
    one = rows.join(kept, same).dropDuplicates([own, number])
    return one.select(*docs.columns)


def query(spark: SparkSession, folder: str) -> DataFrame:
    return join(documents(ship(spark), folder), 4, 85).select("doc_id", "n_shingles", "component_id")
