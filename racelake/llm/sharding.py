"""Balanced label propagation: linked documents into the same shard, shards of equal row counts.

Documents with equal text are linked. Every document starts in a shard by the hash of its id. In each
round the documents of a group that are outside the shard holding most of the group propose to move
there; a shard accepts proposals only as far as its quota goes. The state is one row per (group, lot),
a lot being a 64th of a group, so that a group with a third of all rows is many small rows here and can
be spread over several shards when it exceeds a quota.

The last step makes the counts exact: all rows in the order (shard, group) are cut into equal lengths.
That moves rows at the seams only and cuts few groups. The order is never sorted as a whole: rows are
counted by cells, cells larger than a 2048th of all rows are cut again, and a row's place is the start
of its cell plus its number inside.

Law ``rows``: counts differ by one at most. Cases: a null text has size 1 and crc 0 and is linked to
other null texts; repeated rows each get a place of their own; a null doc_id is placed like any other;
further columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from racelake.llm.staging import documents, staged

SHARDS = 8
LOTS = 64
ROUNDS = 4
SLACK = 1.1
"""quota of a shard during propagation, as a multiple of its even share"""
CELLS = 512
"""cells per shard in the final order; large ones are cut to a 2048th of all rows"""


def _hash_share(*columns: str | Column) -> Column:
    """A number from 0 to 1 that only depends on the columns."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 20)) / float(1 << 20)


def nodes(docs: DataFrame, shards: int) -> DataFrame:
    """One narrow row per document: size, checksum, group, lot and first shard."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.when(F.col("text").isNull(), "null").otherwise(F.md5(data)).alias("group"),
    ).withColumn("lot", F.pmod(F.xxhash64("doc_id"), F.lit(LOTS)).cast("int")).withColumn("first_shard", (F.col("lot") % shards).cast("int"))


def _accepted(flows: list[tuple[int, int, int]], load: dict[int, int], quota: float) -> dict[int, float]:
    """The share of its proposals that each shard takes, so that arrivals fit into its quota and what leaves it."""
    share = {target: 1.0 for _, target, _ in flows}
    for _ in range(50):
        for target in share:
            leaving = sum(n * share[to] for source, to, n in flows if source == target)
            wanted = sum(n for _, to, n in flows if to == target)
            share[target] = max(0.0, min(share[target], (quota - load.get(target, 0) + leaving) / wanted))
    return share


def propagate(rows: DataFrame, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """(group, lot, shard) of the lots that left their first shard; ``rows`` are nodes."""
    lots = rows.groupBy("group", "lot", "first_shard").agg(F.count("*").alias("n"))
    sizes = lots.groupBy("group").agg(F.sum("n").alias("group_n"))
    # an unlinked document has no neighbour to move to: it only counts as load
    linked = lots.join(sizes.filter("group_n > 1"), "group")
    state = staged(linked.withColumn("shard", F.col("first_shard")), "shard-lots")
    load = dict(rows.groupBy("first_shard").count().collect())  # one number per shard
    total = sum(load.values())
    quota = total / shards * SLACK
    for turn in range(rounds):
        held = state.groupBy("group", "shard").agg(F.sum("n").alias("held"))
        # ties go to a shard that differs from group to group
        best = held.groupBy("group").agg(
            F.max_by("shard", F.struct("held", F.xxhash64("group", "shard"))).alias("target")
        )
        proposed = state.join(best, "group")
        moving = F.col("shard") != F.col("target")
        flows = proposed.filter(moving).groupBy("shard", "target").agg(F.sum("n").alias("n")).collect()
        if not flows:
            break
        open_share = _accepted([tuple(r) for r in flows], load, quota)
        share = F.create_map(*(F.lit(x) for s, v in open_share.items() for x in (s, v)))
        # a group moves as a whole, one that is large for a quota lot by lot
        ticket = F.when(F.col("group_n") * 16 > quota, _hash_share("group", "lot", F.lit(turn))).otherwise(
            _hash_share("group", F.lit(turn))
        )
        moved = proposed.withColumn("shard", F.when(moving & (ticket < share[F.col("target")]), F.col("target")).otherwise(F.col("shard")))
        state = staged(moved.drop("target"), "shard-lots")
        change = state.groupBy("shard", "first_shard").agg(F.sum("n").alias("n")).collect()
        load = dict(rows.groupBy("first_shard").count().collect())
        for r in change:
            load[r["first_shard"]] -= r["n"]
            load[r["shard"]] = load.get(r["shard"], 0) + r["n"]
    return state.filter("shard != first_shard").select("group", "lot", "shard")


def _places(rows: DataFrame, shards: int) -> DataFrame:
    """Rows (with column ``label``) with their place in the order by label and group, and the row count."""
    celled = rows.withColumn("cell", F.pmod(F.xxhash64("group"), F.lit(CELLS)).cast("int"))
    counts = celled.groupBy("label", "cell").agg(F.count("*").alias("n"))
    everything = counts.agg(F.sum("n").alias("total"))
    cuts = counts.crossJoin(everything).select(  # at most shards * CELLS rows and one
        "label", "cell", F.ceil(F.col("n") / F.ceil(F.col("total") / 2048)).cast("int").alias("cuts")
    )
    cut = celled.join(staged(cuts, "shard-cells"), ["label", "cell"]).withColumn(
        "cut", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.col("cuts")).cast("int")
    )
    cut = staged(cut.drop("cuts"), "shard-rows")
    # at most shards * CELLS + 2048 cells, whatever the number of rows
    cells = cut.groupBy("label", "cell", "cut").agg(F.count("*").alias("n"))
    order = Window.orderBy("label", "cell", "cut")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = cells.select("label", "cell", "cut", before.alias("before"), F.sum("n").over(Window.partitionBy()).alias("total"))
    inside = F.row_number().over(Window.partitionBy("label", "cell", "cut").orderBy("group", "doc_id"))
    return cut.withColumn("inside", inside).join(staged(starts, "shard-starts"), ["label", "cell", "cut"]).withColumn(
        "place", F.col("before") + F.col("inside") - 1
    )


def shard(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with its shard and its slot there."""
    rows = staged(nodes(docs, shards), "shard-nodes")
    moved = propagate(rows, shards, rounds)
    labelled = rows.join(moved, ["group", "lot"], "left").withColumn("label", F.coalesce("shard", "first_shard")).drop("shard")
    even, rest = F.floor(F.col("total") / shards), F.col("total") % shards
    # the first ``rest`` shards hold one row more
    wide = rest * (even + 1)
    at = F.when(F.col("place") < wide, F.floor(F.col("place") / (even + 1))).otherwise(
        rest + F.floor((F.col("place") - wide) / F.greatest(even, F.lit(1)))
    )
    start = F.col("shard") * even + F.least(F.col("shard"), rest)
    return _places(labelled, shards).withColumn("shard", at.cast("int")).select(
        "doc_id", "size", "text_crc32", "group", F.lit("rows").alias("law"), "shard",
        (F.col("place") - start).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return shard(documents(spark, folder)).drop("group")
