"""Stored tables: what a change reads, rewrites and drops; versions; promotion; run log; generations; order; page store."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from racelake.operators import order
from racelake.plans import bronze
from racelake.sources import generations, staging, stored, tables, versions
from racelake.sources import pages as page_store
from tests.test_plans import plan_of

c = F.col


@pytest.fixture
def table(spark):
    """Rows of five seasons, the null season among them."""
    rows = [(i, i % 10, None if i % 5 == 4 else 2020 + i % 5) for i in range(50)]
    name = staging.table_name("t")
    stored.create(spark.createDataFrame(rows, "id int, v int, season int"), name, ["season"])
    return name


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def files_of(spark, name):
    found = spark.table(name).select("season", c("_metadata.file_path").alias("f")).distinct().collect()
    return {r["season"]: {x["f"] for x in found if x["season"] == r["season"]} for r in found}


def test_update_leaves_other_partitions_alone(spark, table):
    before, files = spark.table(table).collect(), files_of(spark, table)
    changed = stored.update(spark, table, c("id").isin(3, 13, 4), {"v": c("v") + 100})
    assert {r[0] for r in changed.rewritten} == {2023, None} and changed.dropped == []
    assert rows_of(spark.table(table)) == sorted(((r[0], r[1] + 100 * (r[0] in (3, 13, 4)), r[2]) for r in before), key=str)
    after = files_of(spark, table)
    assert {s for s in files if files[s] == after[s]} == {2020, 2021, 2022}
    assert stored.update(spark, table, c("id") > 1000, {"v": F.lit(0)}) == ([], [])
    with pytest.raises(ValueError):
        stored.update(spark, table, None, {"season": F.lit(2020)})
    with pytest.raises(ValueError):
        stored.rewrite(spark, table, spark.table(table).filter("season = 2020"), lambda df: df.withColumn("season", F.lit(1999)))
    stored.update(spark, table, None, {"v": F.lit(7)})
    assert spark.table(table).filter("v = 7").count() == 50


def test_delete_drops_emptied_partitions(spark, table):
    changed = stored.delete(spark, table, (c("season") == 2021) | (c("id") == 2) | (c("id") == 49))
    assert [r[0] for r in changed.dropped] == [2021] and {r[0] for r in changed.rewritten} == {2022, None}
    assert spark.table(table).count() == 38
    assert "2021" not in str(spark.sql(f"SHOW PARTITIONS {table}").collect())
    stored.delete(spark, table, c("season").isNull())
    assert spark.table(table).filter("season is null").count() == 0 and spark.table(table).count() == 29
    stored.truncate(spark, table)
    assert spark.table(table).count() == 0 and spark.table(table).columns == ["id", "v", "season"]


def test_changes_by_key(spark, table):
    keys = spark.createDataFrame([(0,), (5,), (0,), (None,)], "id int")
    changed = stored.delete_keys(spark, [table], keys, ["id"])[table]
    assert [r[0] for r in changed.rewritten] == [2020] and spark.table(table).count() == 48
    deltas = spark.createDataFrame([(10, 1), (10, 2), (999, 5)], "id int, delta int")
    stored.correct(spark, table, deltas, ["id"], "v", "delta")
    assert spark.table(table).filter("id = 10").first()["v"] == 3


def test_a_rewrite_reads_the_touched_partitions_only(spark, table):
    """The plan of the rows to write lists one partition; the search reads the condition's column alone."""
    plans = []

    def change(df):
        plans.append(plan_of(df))
        return df

    concerned = spark.table(table).filter(c("v") == 3).select("season")
    assert re.findall(r"ReadSchema: struct<(.*)>", plan_of(concerned)) == ["v:int"]
    stored.rewrite(spark, table, spark.table(table).filter(c("id") == 1), change)
    assert "PartitionFilters" in plans[0] and "2021" in plans[0].split("PartitionFilters")[1].split("\n")[0]


def test_tables_of_two_partition_columns(spark):
    name = staging.table_name("two")
    rows = [(i, f"k'{i % 2}" if i % 3 else None, dt.date(2020, 1, 1 + i % 2)) for i in range(12)]
    stored.create(spark.createDataFrame(rows, "id int, kind string, day date"), name, ["kind", "day"])
    changed = stored.delete(spark, name, (c("kind") == "k'1") | ((c("kind").isNull()) & (c("day") == "2020-01-01")))
    assert len(changed.dropped) == 2 and not changed.rewritten
    assert rows_of(spark.table(name)) == sorted((r for r in rows if r[1] != "k'1" and not (r[1] is None and r[2].day == 1)), key=str)


def test_promotion_reads_the_seasons_at_hand(spark, table):
    incoming = spark.createDataFrame([(1, 1, 2021), (101, 5, 2021), (104, 5, None)], "id int, v int, season int")
    base = stored.base_of(spark, table, incoming)
    filters = plan_of(base).split("PartitionFilters")[1].split("\n")[0]
    assert "2021" in filters and "isnull(season" in filters and "2022" not in filters
    for _ in range(2):
        stored.promote_into(spark, table, incoming, ["id"])
    assert spark.table(table).count() == 52


def test_promotion_of_files_is_pruned(spark, tmp_path, caplog):
    base, staging_path = str(tmp_path / "b"), str(tmp_path / "s")
    schema = "race_id int, points double, season int"
    tables.overwrite(spark.createDataFrame([(1, 9.0, 2020), (2, 9.0, 2021)], schema), base, partition_by=["season"])
    tables.overwrite(spark.createDataFrame([("2", "1", "2021"), ("3", "1", "2021")], "race_id string, points string, season string"), staging_path)
    for _ in range(2):
        tables.promote_table(spark, staging_path, base, schema, ["race_id"], partition_by=["season"])
    assert sorted(r["race_id"] for r in tables.read(spark, base).collect()) == [1, 2, 3]


def test_overwritten_partitions_may_end_up_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(spark.createDataFrame([(2020, 1), (2021, 2), (2022, 3)], "season int, v int"), path, partition_by=["season"])
    left = tables.read(spark, path).filter("season in (2021, 2022) and v <> 2").withColumn("v", c("v") + 10)
    tables.overwrite_partitions(left, path, ["season"], touched=[(2021,), (2022,)])
    assert rows_of(tables.read(spark, path).select("season", "v")) == [(2020, 1), (2022, 13)]


def test_versions(spark):
    name = staging.table_name("v")
    assert versions.versions(spark, name) == []
    with pytest.raises(ValueError):
        versions.read(spark, name)
    rows = spark.range(4).selectExpr("id", "id % 2 AS season")
    assert versions.write(rows, name, ["season"], written_at="a") == 0
    # a version may be derived from the one before, and may be empty
    assert versions.write(versions.read(spark, name).unionByName(rows.filter("id = 1")), name) == 1
    assert versions.write(rows.filter("false"), name) == 2
    assert versions.read(spark, name).count() == 0 and versions.read(spark, name, 1).count() == 5
    assert [r["row_count"] for r in versions.history(spark, name).orderBy("_version").collect()] == [4, 5, 0]
    rows.selectExpr("id", "3 AS _version", "season").write.insertInto(name)  # a write that never got into the log
    assert versions.versions(spark, name) == [0, 1, 2]
    assert versions.restore(spark, name, 0) == 4
    assert versions.read(spark, name).count() == 4 and versions.read_all(spark, name).count() == 13
    plan = plan_of(versions.read(spark, name, 1).filter("season = 1"))
    filters = plan.split("PartitionFilters")[1].split("\n")[0]
    assert "_version" in filters and "season" in filters and "= 1" in filters
    assert versions.expire(spark, name, 2) == [0, 1]
    assert versions.versions(spark, name) == [2, 4]
    with pytest.raises(ValueError):
        versions.read(spark, name, 0)
    with pytest.raises(ValueError):
        versions.expire(spark, name, 0)


def test_run_steps_are_counted_while_they_are_written(spark, tmp_path):
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    written = []

    def write(df):
        written.append(df)
        tables.overwrite(df, out)

    figures = tables.run_step(spark.range(7), write, log, {"even": F.count_if(c("id") % 2 == 0)}, Action="load")
    assert figures == {"rows": 7, "even": 4} and len(written) == 1 and tables.read(spark, out).count() == 7
    row = tables.read(spark, log).first()
    assert row["Coment"] == "rows=7, even=4" and row["Action"] == "load" and row["Datetime_Star"] <= row["Datetime_end"]


def test_generations(spark, tmp_path):
    path = str(tmp_path / "g")
    assert generations.listed(spark, path) == [] and generations.read(spark, path, "a int").count() == 0
    assert generations.append(spark.createDataFrame([(1, 2)], "a int, season int"), path, ["season"]) == 0
    assert generations.append(spark.createDataFrame([("3", "x", 2)], "a string, b string, season int"), path, ["season"]) == 1
    assert generations.append(spark.createDataFrame([("?", 1.5, 3)], "a string, c double, season int"), path, ["season"]) == 2
    schema = "a bigint, c double, season int"
    assert rows_of(generations.read(spark, path, schema)) == [(1, None, 2), (3, None, 2), (None, 1.5, 3)]
    assert "PartitionFilters: [isnotnull(season" in plan_of(generations.read(spark, path, schema).filter("season = 3"))
    name = staging.table_name("moved")
    assert generations.migrate(spark, path, name, schema, ["season"]) == 3
    assert rows_of(spark.table(name)) == [(1, None, 2), (3, None, 2), (None, 1.5, 3)]


def test_positions(spark):
    rows = spark.range(1000).selectExpr("(id * 7919) % 1000 AS v", "id").repartition(7)
    found = order.with_position(rows, [F.desc("v")], "no").collect()
    assert [(r["v"], r["no"]) for r in found] == [(999 - i, i + 1) for i in range(1000)]
    assert order.with_position(rows.filter("false"), ["v"], "no").count() == 0
    assert [r["no"] for r in order.with_position(spark.createDataFrame([(1,), (1,), (None,)], "v int"), ["v"], "no").collect()] == [1, 2, 3]


def test_a_bucketed_page_store_is_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pages = spark.createDataFrame(
            [(1, "u", "<h1>old</h1>", "1"), (2, "u", "<h1>new</h1><table><tr><th>a</th></tr><tr><td>b</td></tr></table>", "2"), (3, "w", "<h1>w</h1>", "1")],
            "page_id long, url string, html string, scraped_at_utc string",
        )
        store = page_store.store(pages, staging.table_name("pages"))
        plan = spark.createDataFrame([("u", "k"), ("u", "l"), ("x", "k"), ("w", "k"), (None, "k")], "page_url string, kind string")
        read = bronze.parse_stored(plan, store)
        text = plan_of(read)
        exchanged = re.findall(r"\) Exchange\n.*?Input \[\d+\]: \[(.*?)\]", text, re.S)
        assert not [x for x in exchanged if "html" in x or "page_id" in x] and text.count("MapInArrow") <= 2
        reads = re.findall(r"ReadSchema: struct<(.*)>", text)
        assert sum("html" in r for r in reads) == 1 and len(reads) == 2
        found = {(r["page_url"], r["kind"]): (r["event_title"], r["error"], r["tables"]) for r in read.collect()}
        assert found["u", "k"][0] == found["u", "l"][0] == "new" and found["u", "k"][2][0]["rows"][0]["cells"] == ["b"]
        assert found["w", "k"] == ("w", None, []) and found["x", "k"][1] == found[None, "k"][1] == page_store.NOT_STORED
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_index_is_parsed_once(spark):
    link = '<a href="/en/results/2024/races/{0}/gp/race-result">GP {0}</a>'
    markup = "<table><tr><th>Grand Prix</th><th>Date</th></tr>" + "".join(f"<tr><td>{link.format(i)}</td><td>{i} Mar</td></tr>" for i in (1, 2)) + "</table>"
    sprint = "<table><tr><th>Pos.</th><th>Driver</th><th>Laps</th></tr><tr><td>1</td><td>Ann</td><td>9</td></tr></table>"
    base = "https://results.example.org/en/results/2024/races"
    pages = spark.createDataFrame(
        [(1, base, "<p>stale</p>", "1"), (2, base, markup, "2"), (3, f"{base}/1/gp/sprint-results", sprint, "2")],
        "page_id long, url string, html string, scraped_at_utc string",
    )
    races = bronze.list_races(pages)
    assert plan_of(races).split("+- == Initial Plan ==")[0].count("MapInArrow (") <= 1
    assert {(r["race_id"], r["sprint"]) for r in races.collect()} == {(1, "Y"), (2, "N")}
