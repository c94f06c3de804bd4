"""Findings of round four: promotion by keys, parsed pages apart by kind, headers of a table at once."""

from pyspark.sql import functions as F

from racelake.functions import links
from racelake.plans import bronze, weekend
from racelake.plans.layouts import normal_headers
from racelake.sources import staging, stored
from racelake.sources.staging import _WRITING


def _files(spark, name):
    return sorted(spark.table(name).inputFiles())


def test_promotion_moves_no_rows_if_all_keys_are_new_or_none_is(spark, monkeypatch):
    joins, promote = [], stored.promote
    monkeypatch.setattr(stored, "promote", lambda *a: joins.append(1) or promote(*a))
    name = staging.table_name("promoted")
    rows = spark.createDataFrame([(1, "a", 2024), (1, "b", 2024), (None, "c", 2024), (2, "d", 2025)], "race_id int, driver string, season int")
    stored.create(rows.filter(F.lit(False)), name, ["season"])
    stored.promote_into(spark, name, rows, ["race_id"])
    files = _files(spark, name)
    stored.promote_into(spark, name, rows, ["race_id"])
    assert _files(spark, name) == files and not joins
    stored.promote_into(spark, name, rows.filter(F.lit(False)), ["race_id"])
    more = spark.createDataFrame([(None, "x", 2024), (1, "y", 2024), (3, "e", 2024), (3, "f", 2024), (2, "z", 2025)], "race_id int, driver string, season int")
    stored.promote_into(spark, name, more, ["race_id"])
    assert joins == [1] and sorted(r["driver"] for r in spark.table(name).collect()) == list("abcdef")


def test_staged_parts_are_read_alone(spark):
    rows = spark.range(20).selectExpr("id", "if(id = 7, null, concat('k-', id % 2)) as kind", "array(id) as more")
    parts = staging.staged(rows, "parts", ["kind"])
    assert parts.dtypes == rows.dtypes and sorted(parts.collect()) == sorted(rows.collect())
    plan = parts.filter("kind = 'k-1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan and parts.filter("kind = 'k-1'").count() == 9


def test_settings_of_a_write_end_with_it(spark):
    before = {key: spark.conf.get(key, None) for key in _WRITING}
    try:
        with staging.writing(spark):
            assert all(spark.conf.get(key) == value for key, value in _WRITING.items())
            raise ValueError
    except ValueError:
        pass
    assert {key: spark.conf.get(key, None) for key in _WRITING} == before


def test_headers_of_a_table_are_made_normal_at_once(spark):
    rows = [["Pos.", "Time  / \t Retired", ""], [" A ", "", "B"], ["", "x"], ["É\tÜ"], ["a b c"]]
    got = [r[0] for r in spark.createDataFrame([(r,) for r in rows], "h array<string>").select(normal_headers(F.col("h"))).collect()]
    assert got == [["pos.", "time / retired", ""], ["a", "", "b"], ["", "x"], ["é ü"], ["a b c"]]


def test_sprint_pages_are_planned_per_race_and_looked_up_alone(spark):
    root = "https://r.example.org/en/results/2024/races"
    races = spark.createDataFrame([(f"{root}/1/a/race-result",)] * 3 + [("",), (None,)], "url string")
    plan = weekend.sprint_plan(races)
    assert sorted((r["race_url"], r["kind"], r["page_url"]) for r in plan.filter("race_url != ''").collect()) == sorted(
        (f"{root}/1/a/race-result", k, f"{root}/1/a/{k}") for k in weekend.SPRINT_KINDS)
    assert [r["page_url"] for r in plan.filter("race_url = ''").collect()] == [None] * 3
    shown = "<table><tr><th>Pos.</th><th>Driver</th><th>Laps</th></tr><tr><td>1</td><td>A</td><td>9</td></tr></table>"
    found = spark.createDataFrame([(1, f"{root}/1/a/sprint-grid", shown, "t"), (2, f"{root}/1/a/race-result", shown, "t")], "page_id long, url string, html string, scraped_at_utc string")
    flags = bronze.sprint_races(races, found)
    assert [tuple(r) for r in flags.collect()] == [(f"{root}/1/a/race-result", True)]
    assert flags._jdf.queryExecution().optimizedPlan().toString().count("IN (sprint-results,sprint-qualifying,sprint-grid)") >= 2


def test_plain_links_skip_the_steps_of_dotted_ones(spark):
    cases = {"/a/b?x=1": "https://h.org/a/b?x=1", "/a/../b": "https://h.org/b", "/a/.": "https://h.org/a/", "/.x/b": "https://h.org/.x/b", "//o.org/p": "https://o.org/p",
             "mailto:x": "mailto:x", "c": "https://h.org/s/c", "/a?b=/../c": "https://h.org/a?b=/../c", "": "https://h.org/s/t"}
    rows = spark.createDataFrame([("https://h.org/s/t", h) for h in cases], "page string, href string")
    assert [r[0] for r in rows.select(links.absolute(F.col("page"), F.col("href"))).collect()] == list(cases.values())
