"""Joins, session values, changes and reports on hand-written rows, hot keys included."""

import random

import pytest
from pyspark.sql import functions as F

from racelake.operators import changes, lookups, reports, sessions, shape, snapshots
from racelake.sources import generators

c = F.col


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one key, null keys among them."""
    random.seed(7)
    rows = []
    for i in range(6000):
        key = 1 if i % 3 == 0 else (None if i % 50 == 1 else random.randrange(2, 900))
        rows.append((key, i % 3, random.choice([None, *range(20)]), random.choice([None, i * 0.5]), i))
    return rows, spark.createDataFrame(rows, "race_id int, practice_no int, position int, time_s double, id int").repartition(6)


def test_leader_value_against_brute_force(skewed):
    rows, df = skewed
    best = {}
    for race, no, position, secs, _ in rows:
        if secs is not None:
            rank = (position is None, position or 0, secs)
            best[(race, no)] = min(best.get((race, no), (True, 10**9, 0.0)), rank)
    expected = sorted(((i, best.get((race, no), (0, 0, None))[2]) for race, no, _, _, i in rows), key=repr)
    got = sessions.leader_value(df, ["race_id", "practice_no"], ["position"], "time_s", "base", ["id"])
    assert rows_of(got.select("id", "base")) == expected


def test_winner_gaps_against_brute_force(spark, skewed):
    rows, df = skewed
    told = df.withColumns({"position": F.when(c("position") < 3, c("position")), "t": F.concat(F.lit("+"), (c("id") % 60).cast("string"))})
    winner = {}
    for race, _, position, _, i in rows:
        if position == 1:
            winner[race] = min(winner.get(race, i), i)
    expected = []
    for race, _, _, _, i in rows:
        won = race in winner and winner[race] == i
        expected.append((i, float(i % 60) if won else None, float(i % 60) if race in winner and not won else None))
    got = sessions.winner_gaps(told, ["race_id"], "position", "t", "id").select("id", "race_time_s", "gap_to_winner_s")
    assert rows_of(got) == sorted(expected, key=repr)


def test_hot_keys_are_split_at_run_time(spark):
    """Without any broadcast, adaptive execution splits the hot key of an attach join."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        rows = spark.range(60_000).repartition(12).select(
            F.when(c("id") % 3 == 0, -1).otherwise(c("id")).alias("key"), "id", F.sha2(c("id").cast("string"), 256).alias("payload")
        )
        per_key = rows.groupBy("key").agg(F.count("*").alias("n"))
        joined = lookups.attach(rows, per_key, ["key"], ["id"], salts=1)
        total = joined.agg(F.count("*"), F.sum("n")).collect()[0]
        assert tuple(total) == (60_000, 20_000 * 20_000 + 40_000)
        spread = lookups.attach(rows, per_key, ["key"], ["id"]).agg(F.count("*"), F.sum("n")).collect()[0]
        assert tuple(spread) == tuple(total)
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_salts_spread_a_hot_key(spark):
    rows = spark.range(0, 9000, 1, 3).select(F.lit(1).alias("key"), "id")
    salt = F.pmod(F.xxhash64("id") + F.spark_partition_id(), F.lit(lookups.SALTS))
    counts = [r["count"] for r in rows.groupBy(salt).count().collect()]
    assert len(counts) == lookups.SALTS and max(counts) < 2 * 9000 / lookups.SALTS


def test_unseen_compares_null_keys(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c"), (2, "d")], "k int, v string")
    known = spark.createDataFrame([(1,), (None,), (1,)], "k int")
    assert rows_of(lookups.unseen(rows, known, ["k"])) == [(2, "c"), (2, "d")]


def test_registering_twice_appends_once(spark):
    schema = "season int, gp string, date_text string, url string, sprint string, scraped_at_utc string, silver string, bronze string, race_id int"
    staged = spark.createDataFrame([(2024, g, "", "", "N", "", "", "", i) for i, g in enumerate("abc")], schema)
    known = spark.createDataFrame(
        [(2024, "a", "", "", "N", "", "N", "Y", 0), (2024, "b", "", "", "N", "", "N", "N", 1), (2023, "c", "", "", "N", "", "N", "Y", 9)], schema
    )
    first = lookups.register_races(staged, known, 2024)
    assert rows_of(first.staged.select("gp", "bronze", "silver")) == [("a", "Y", "N"), ("b", "N", "N"), ("c", "N", "N")]
    assert rows_of(first.pending.select("gp")) == [("b",), ("c",)]
    assert rows_of(first.to_append.select("gp")) == [("c",)]
    again = lookups.register_races(staged, known.unionByName(first.to_append), 2024)
    assert again.to_append.count() == 0 and again.staged.columns == staged.columns


def test_flags_do_not_multiply_rows(spark):
    rows = spark.createDataFrame([(1, "x")], "k int, bronze string")
    known = spark.createDataFrame([(1, "N"), (1, "Y"), (1, None)], "k int, bronze string")
    assert rows_of(lookups.carry_flag(rows, known, ["k"], "bronze")) == [(1, "Y")]


def test_changes(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, None, 6), (3, "b", None)], "id int, flag string, n int")
    assert rows_of(changes.update_where(df, c("flag") == "a", {"n": c("n") + 1, "flag": F.lit("z")})) == [(1, "z", 6), (2, None, 6), (3, "b", None)]
    assert rows_of(changes.delete_where(df, c("flag") == "a")) == [(2, None, 6), (3, "b", None)]
    doomed = spark.createDataFrame([(3,), (3,), (None,)], "id int")
    assert rows_of(changes.delete_keys(df, doomed, ["id"])) == [(1, "a", 5), (2, None, 6)]
    assert changes.emptied(df).count() == 0 and changes.emptied(df).schema == df.schema
    assert {r[1] for r in changes.confirm(df, "flag").collect()} == {"Y"}


def test_corrections_add_up_and_keep_rows(spark):
    results = spark.createDataFrame([(1, "8", 4.0), (1, "8", 0.0), (2, "2", None), (3, "1", 25.0)], "Race_Id int, Position string, Points double")
    deltas = spark.createDataFrame([(1, "8", 1), (1, "8", 1), (2, "2", 1), (9, "1", 1)], "Race_Id int, Position string, Delta int")
    got = changes.correct(results, deltas, ["Race_Id", "Position"], "Points", "Delta")
    assert got.schema == results.schema
    assert rows_of(got) == [(1, "8", 2.0), (1, "8", 6.0), (2, "2", None), (3, "1", 25.0)]


def test_scratched(spark):
    schema = "status string, laps int, time_or_retired string"
    rows = spark.createDataFrame([("Finished", None, None), ("Finished", 1, None), ("DNF", None, None), (None, None, None)], schema)
    assert [r[2] for r in changes.mark_scratched(rows).collect()] == ["SHC", None, None, None]


def test_conform_matches_spelling_exactly(spark):
    df = spark.createDataFrame([("1", "x")], "laps string, Other string")
    got = shape.conform(df, "laps int, other string, gone double")
    assert got.columns == ["laps", "other", "gone"] and tuple(got.collect()[0]) == (1, None, None)


def test_split_keeps_every_row(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "n int")
    yes, no = shape.split_rows(df, c("n") > 2)
    assert (yes.count(), no.count()) == (1, 2)


def test_reports(spark):
    df = spark.createDataFrame([(2024, 5, 1.5, "a"), (2023, 7, 2.0, "a")], "season int, laps int, secs double, k string")
    assert df.agg(reports.season_title(c("season"))).collect()[0][0] == "2024 RACE RESULTS"
    assert [r[0] for r in reports.season_choices(df, "season").collect()] == [2024, 2023]
    assert rows_of(reports.rollup_defaults(df, ["k"])) == [("a", 4047, 12, 3.5)]
    assert df.agg(reports.total_clock(c("secs") * 1000)).collect()[0][0] == "00:58:20"


def test_generators(spark):
    years = generators.seasons(spark, current=2025).collect()
    assert len(years) == 76 and [r["year"] for r in years if r["IsCurrentSeason"] == "Y"] == [2025] and years[0]["year"] == 2025
    assert generators.days(spark).count() == 36890


def test_snapshots(spark):
    df = spark.createDataFrame([(0, 1, "t0"), (1, 1, "t1"), (1, 2, "t1")], "_version int, id int, at string")
    assert rows_of(snapshots.at_version(df, 1)) == [(1, "t1"), (2, "t1")]
    assert rows_of(snapshots.history(df, "at")) == [(0, 1, "t0"), (1, 2, "t1")]
    assert rows_of(snapshots.at_version(snapshots.restored(df, 0, 2), 2)) == [(1, "t0")]
