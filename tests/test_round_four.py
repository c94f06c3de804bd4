"""Joins that must not bring a store to the driver, and pages of plain rows."""

import re

from pyspark.sql import functions as F
from pyspark.sql import types as T

from racelake.functions import durations
from racelake.plans import bronze, weekend
from racelake.plans.layouts import LAYOUTS
from racelake.sources import html
from racelake.sources.pages import newest_copies

ROOT = "https://r.example.org/en/results"


def _broadcasts(df):
    return re.findall(r"Broadcast\w*Exchange", df._jdf.queryExecution().sparkPlan().toString() + df._jdf.queryExecution().executedPlan().toString())


def test_lookups_of_long_plans_do_not_broadcast(spark):
    """Both sides look small to the planner here, as derived tables do; neither is known to be."""
    races = spark.range(50).select(F.lit(2024).alias("season"), F.concat(F.lit(f"{ROOT}/2024/races/"), "id", F.lit("/a/race-result")).alias("url"))
    pages = spark.range(50).select(
        F.col("id").alias("page_id"), F.concat(F.lit(f"{ROOT}/"), "id", F.lit("/races")).alias("url"), F.lit("<p>").alias("html"), F.lit("t").alias("scraped_at_utc"))
    assert not _broadcasts(bronze.season_races(pages.unionByName(pages.withColumn("page_id", F.col("page_id") + 50))))
    plan = weekend.sprint_plan(races)
    assert not _broadcasts(newest_copies(plan, pages))


def test_newest_copy_of_an_index_counts(spark):
    index = "<table><tr><th>Grand Prix</th><th>Date</th></tr><tr><td><a href='/en/results/2024/races/{0}/b'>{0}</a></td><td>1 May</td></tr></table>"
    url = f"{ROOT}/2024/races"
    pages = spark.createDataFrame(
        [(1, url, index.format(1), "t1"), (2, url, index.format(2), "t2"), (3, url, index.format(3), "t2"), (4, url, index.format(4), "t0")],
        "page_id long, url string, html string, scraped_at_utc string")
    assert [r["race_id"] for r in bronze.season_races(pages).collect()] == [3]


def test_a_spanning_cell_is_read_once(monkeypatch):
    reads, read = [], html._Cell.text
    monkeypatch.setattr(html._Cell, "text", lambda cell: reads.append(cell) or read(cell))
    page = "<table><tr><td>1</td><td>2</td></tr><tr><td colspan=1000>* note</td></tr></table>"
    (table,) = html.parse_tables(page)
    assert table["rows"][1]["cells"] == ["* note"] * 1000 and table["rows"][0]["cells"] == ["1", "2"] + [None] * 998
    assert len(reads) == 1


def test_rows_of_words_read_as_cell_by_cell():
    page = (
        "<table><tr><th>A</th> <th>B</th></tr><TR class=x><TD>1</TD>\n<td id='q'> b &amp; c </td></tr><tr><td>a  b</td><td></td></tr>"
        "<tr><td>display</td><td>span</td></tr><tr><td style='display:none'>no</td><td>yes</td></tr><tr><td rowspan=2>r</td><td>s</td></tr>"
        "<tr><td>t</td></tr><tr><td>u</td><td>v<table><tr><td>in</td></tr></table></td></tr></table>"
    )
    outer, inner = html.parse_tables(page)
    assert outer["headers"] == ["A", "B"]
    assert [r["cells"] for r in outer["rows"]] == [
        ["1", "b & c"], ["a b", None], ["display", "span"], ["yes", None], ["r", "s"], ["r", "t"], ["u", "vin"]]
    assert [r["cells"] for r in inner["rows"]] == [["in"]]


def test_expressions_search_a_page_once(spark):
    """What a page's title and tables are made from stands in the plan once, however often it is used."""
    pages = spark.createDataFrame([("<!-- <h1>no</h1> --><h1>A <b>1</b> &amp; B</h1>",)], "html string")
    titled = pages.select(html.title(F.col("html")).alias("t"))
    assert titled.first()["t"] == "A 1 & B"
    assert titled._jdf.queryExecution().optimizedPlan().toString().count("</script>") == 1
    tables = spark.createDataFrame([], T.StructType([T.StructField("tables", html.TABLES)]))
    plan = tables.select(bronze._first_table(LAYOUTS["race-result"].recognised).alias("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 1


def test_words_are_no_times_or_numbers(spark):
    cells = {"+1:02.5s": 62.5, "DNF": None, "s": None, "++5ss": 5.0, "-0": 0.0, "1:2:3": 3723.0, "": None, "5 s": None, None: None}
    rows = spark.createDataFrame([(x,) for x in cells], "c string")
    got = [r[0] for r in rows.select(durations.seconds(F.col("c"))).collect()]
    assert [None if x is None else repr(x) for x in got] == [None if x is None else repr(x) for x in cells.values()]
    guarded = rows.select(durations.seconds(F.col("c")).alias("s"))._jdf.queryExecution().optimizedPlan().toString()
    assert "split(CASE WHEN" in guarded  # words never reach a cast


def test_a_pages_table_is_looked_for_once(spark):
    fields = "season int, race_url string, kind string, practice_no int, page_url string, scraped_at_utc string, event_title string, error string"
    schema = T.StructType([*T.StructType.fromDDL(fields).fields, T.StructField("tables", html.TABLES)])
    row, heads = (["1", "5", "A B", "T", "9", "1:2.5", "3"], None), ["Pos.", "No.", "Driver", "Team", "Laps", "Time / Retired", "Pts."]
    page = (2024, f"{ROOT}/2024/races/1/a/race-result", "race-result", None, "p", "t", "x", None)
    parsed = spark.createDataFrame([(*page, [(["A"], []), (heads, [row, row])]), (*page, [(["A"], [row])]), (*page, [(heads, [])]), (*page, [])], schema)
    rows = bronze.rows_of(parsed, "race-result")
    assert rows.count() == 2
    assert len(re.findall(r"array_contains\([^,]*headers, time / retired\)", rows._jdf.queryExecution().optimizedPlan().toString())) == 1
