"""What reaches the scan: filters, columns and partitions."""

import re

import pytest

from racelake import schemas
from racelake.operators import lookups
from racelake.operators.shape import conform
from racelake.plans import gold, silver, weekend
from racelake.sources import pages as page_store
from racelake.sources import tables


def plan_of(df):
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    one = spark.range(1).selectExpr("2024 AS season", "1 AS race_id")
    for name, schema in {"results": schemas.RESULTS, "races": schemas.RACES, "clean": schemas.CLEAN_RESULTS}.items():
        tables.overwrite(conform(one, schema), f"{root}/{name}")
    return {n: tables.read(spark, f"{root}/{n}") for n in ("results", "races", "clean")}


def test_cleaning_is_one_filtered_scan(lake):
    plan = plan_of(silver.clean_results(lake["results"]))
    assert "IsNotNull(points)" in plan and "Exchange" not in plan
    narrow = plan_of(silver.clean_results(lake["results"]).select("Race_Id", "Points"))
    read = re.search(r"ReadSchema: struct<(.*)>", narrow)[1]
    assert set(re.findall(r"(\w+):", read)) == {"position", "points", "race_id", "season"}


def test_worklist_and_report_filters_reach_the_scan(spark, lake):
    assert "EqualTo(season,2024), EqualTo(bronze,N)" in plan_of(weekend.worklist(lake["races"], 2024))
    races = lake["races"].selectExpr("race_id AS Race_Id", "season AS Season", "gp AS Country", "gp AS Gp", "date_text AS Date")
    countries = spark.createDataFrame([("a", "u")], "Country string, URL_Download string")
    plan = plan_of(gold.season_winners(lake["clean"], races.withColumn("Date", races["Date"].try_cast("date")), countries, [2024]))
    assert "EqualTo(Position,1)" in plan and "EqualTo(Status,Finished)" in plan and "EqualTo(season,2024)" in plan


def test_promotion_reads_only_keys_of_the_base(lake):
    plan = plan_of(lookups.promote(lake["results"], lake["results"].filter("season = 2024"), ["race_id"]))
    reads = re.findall(r"ReadSchema: struct<(.*)>", plan)
    assert "race_id:int,season:int" in reads


def test_partitions_are_pruned(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite(spark.range(10).selectExpr("id", "2020 + id % 3 AS season"), path, partition_by=["season"])
    assert "PartitionFilters: [isnotnull(season" in plan_of(tables.read(spark, path).filter("season = 2021"))


def test_markup_is_read_once_and_not_moved_for_a_short_plan(spark, tmp_path):
    path = str(tmp_path / "pages")
    schema = "page_id long, url string, html string, scraped_at_utc string"
    tables.overwrite(spark.createDataFrame([(1, "u", "<table>", "t")], schema), path)
    plan = spark.createDataFrame([("u", "k")], "page_url string, kind string")
    text = plan_of(page_store.read_pages(plan, tables.read(spark, path), {}))
    reads = re.findall(r"ReadSchema: struct<(.*)>", text)
    assert sum("html" in r for r in reads) == 1
    exchanged = [x for x in re.findall(r"\) Exchange\n.*?Input \[\d+\]: \[(.*?)\]", text, re.S) if "html" in x]
    assert not exchanged
