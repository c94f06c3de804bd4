"""Sources and sinks on files of a temporary folder."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from racelake import schemas
from racelake.sources import tables

c = F.col


def test_overwrite_append_publish(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    tables.overwrite(spark.range(3), a)
    tables.append(spark.range(2), a)
    assert tables.read(spark, a).count() == 5
    tables.overwrite(spark.range(1).withColumn("x", F.lit(1)), a)
    assert tables.read(spark, a).columns == ["id", "x"]
    tables.publish(spark, a, b)
    assert tables.read(spark, b, schema="id bigint, x int").collect() == tables.read(spark, a).collect()


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(spark.createDataFrame([(2020, 1), (2021, 2)], "season int, v int"), path, partition_by=["season"])
    untouched = next((tmp_path / "t" / "season=2020").glob("*.parquet")).name
    fixed = tables.read(spark, path).filter("season = 2021").withColumn("v", c("v") + 10)
    tables.overwrite_partitions(fixed, path, ["season"])
    assert sorted(map(tuple, tables.read(spark, path).select("season", "v").collect())) == [(2020, 1), (2021, 12)]
    assert os.path.exists(tmp_path / "t" / "season=2020" / untouched)


def test_promotion_is_idempotent(spark, tmp_path):
    staging, base = str(tmp_path / "s"), str(tmp_path / "b")
    schema = "race_id int, points double"
    tables.overwrite(spark.createDataFrame([("1", "5"), ("2", "x"), ("2", "7")], "race_id string, points string"), staging)
    tables.overwrite(spark.createDataFrame([(1, 9.0)], schema), base)
    for _ in range(2):
        tables.promote_tables(spark, {"r": (staging, base)}, {"r": schema}, ["race_id"])
    assert sorted(map(tuple, tables.read(spark, base).collect()), key=repr) == [(1, 9.0), (2, 7.0), (2, None)]


def test_catalog_tables_and_type_migration(spark):
    for name in ("results", "results_bk"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    tables.save_table(spark.createDataFrame([(1, 5), (2, None)], "id int, points int"), "results")
    tables.save_table(spark.createDataFrame([(3, 6)], "id int, points int"), "results", mode="append")
    tables.migrate_types(spark, "results", "results_bk", "id int, points double")
    assert dict(tables.table(spark, "results").dtypes)["points"] == "double"
    assert sorted(map(tuple, spark.table("results").collect()), key=repr) == [(1, 5.0), (2, None), (3, 6.0)]
    assert spark.table("results_bk").count() == 3
    tables.alias(spark.table("results"), "also_results")
    assert spark.table("also_results").count() == 3


def test_run_log(spark, tmp_path):
    path, at = str(tmp_path / "log"), dt.datetime(2024, 1, 2, 3, 4, 5)
    for action in ("load", "clean"):
        tables.log_run(spark, path, at, at, User_Name="me", IsPipeline=True, Action=action)
    rows = tables.read(spark, path).orderBy("Action").collect()
    assert [r["Action"] for r in rows] == ["clean", "load"] and rows[0]["Datetime_Star"] == at and rows[0]["Coment"] is None
    with pytest.raises(ValueError):
        tables.run_log_row(spark, at, at, Nope=1)
    assert tables.literal_rows(spark, [], schemas.RACES).columns == schemas.names(schemas.RACES)


def test_sql_source_options():
    plain = tables.sql_source_options("jdbc:x", "dbo.t")
    assert plain == {"url": "jdbc:x", "dbtable": "dbo.t", "queryTimeout": "7200"}
    split = tables.sql_source_options("jdbc:x", "t", "id", (0, 100), 8, fetchsize=1000)
    assert split["numPartitions"] == "8" and split["upperBound"] == "100" and split["fetchsize"] == "1000"
    with pytest.raises(ValueError):
        tables.sql_source_options("jdbc:x", "t", "id")
