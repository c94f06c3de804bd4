"""Plans under a filter, stale copies, references, links and running from another folder."""

import os
import subprocess
import sys
from datetime import datetime

from pyspark.sql import functions as F

from racelake.functions import links
from racelake.operators import changes, lookups
from racelake.plans import bronze
from racelake.sources import generators, html


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_season_filter_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "facts")
    rows = spark.range(200).selectExpr("id", "id % 7 as race_id", "id * 1.5 as points", "cast(2020 + id % 3 as int) as season")
    rows.write.partitionBy("season").parquet(path)
    facts = spark.read.parquet(path)
    deltas = spark.createDataFrame([(1, 2.0)], "race_id long, delta double")
    corrected = changes.correct(facts, deltas, ["race_id"], "points", "delta").filter("season = 2021")
    assert "PartitionFilters: [isnotnull(season" in plan_of(corrected)
    left = changes.delete_keys(facts, deltas.select("race_id"), ["race_id"])
    assert "PartitionFilters: [isnotnull(season" in plan_of(left.filter("season = 2021"))
    assert "ReadSchema: struct<race_id:bigint>" in plan_of(left.agg(F.count("*")))
    assert left.count() == 200 - rows.filter("race_id = 1").count()


def test_newest_index_copy_counts(spark):
    def index(*races):
        cells = "".join(f'<tr><td><a href="/en/results/2024/races/{i}/x/race-result">{gp}</a></td><td>1 Jan</td></tr>' for i, gp in races)
        return f"<table><thead><tr><th>Grand Prix</th><th>Date</th><th>Winner</th></tr></thead><tbody>{cells}</tbody></table>"

    url = "https://h.org/en/results/2024/races"
    pages = spark.createDataFrame(
        [(1, url, index((1, "a")), datetime(2024, 1, 1)), (2, url, index((1, "a"), (2, "b")), datetime(2024, 2, 1))],
        "page_id long, url string, html string, scraped_at_utc timestamp",
    )
    found = bronze.season_races(pages).select("gp", "race_id").collect()
    assert sorted(map(tuple, found)) == [("a", 1), ("b", 2)]


def test_a_race_staged_twice_is_appended_once(spark):
    shape = "season int, gp string, url string, bronze string, silver string"
    staged = spark.createDataFrame([(2024, "a", "u", None, None)] * 2, shape)
    known = spark.createDataFrame([], shape)
    assert lookups.register_races(staged, known).to_append.count() == 1


def test_character_references_and_link_spellings(spark):
    markup = "<h1>S&atilde;o Paulo &#233; &#x2013; a&b &unknown; &amp;</h1><a href='/one?x=1&amp;y=2'>1</a><a class=k href=/two>2</a><a href=\"/three\">3</a>"
    pages = spark.createDataFrame([("https://h.org/a/b", markup)], "url string, html string")
    assert pages.select(html.title(F.col("html"))).first()[0] == "São Paulo é – a&b &unknown; &"
    found = html.page_links(pages, []).orderBy("link_no").collect()
    assert [r["href"] for r in found] == ["/one?x=1&y=2", "/two", "/three"]


def test_dot_segments_are_resolved(spark):
    cases = {"../x": "https://h.org/a/x", "./x?q=../y": "https://h.org/a/b/x?q=../y", "../../../x/.": "https://h.org/x/", "/p/../q#..": "https://h.org/q#.."}
    rows = spark.createDataFrame([(k, v) for k, v in cases.items()], "href string, want string")
    got = rows.select(links.absolute(F.lit("https://h.org/a/b/c"), F.col("href")), "want").collect()
    assert [r[0] for r in got] == [r[1] for r in got]


def test_days_have_both_ends(spark):
    days = [str(r[0]) for r in generators.days(spark, "2024-02-28", "2024-03-01").orderBy("Date").collect()]
    assert days == ["2024-02-28", "2024-02-29", "2024-03-01"]


def test_pages_are_read_from_another_folder(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = tmp_path / "job.py"
    script.write_text(
        f"import sys; sys.path.insert(0, {root!r})\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "from racelake.sources import html\n"
        "pages = spark.createDataFrame([(1, '<table><tr><th>a</th></tr><tr><td>b</td></tr></table>')], 'id long, html string')\n"
        "assert html.extract_tables(pages, ['id']).first()['error'] is None\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180)
    assert done.returncode == 0, done.stderr[-2000:]
