"""Session plan, page lookup and bronze rows."""

import pytest
from pyspark.sql import functions as F

from racelake.plans import bronze, silver, weekend

ROOT = "https://r.example.org/en/results"
RESULT = (
    "<h1>Bahrain <b>2021</b></h1><table><tr><th>x</th></tr><tr><td>y</td></tr></table><table><thead><tr><th>Pos.</th><th>No.</th><th>Driver</th>"
    "<th>Team</th><th>Laps</th><th>Time / Retired</th><th>Pts.</th></tr></thead><tbody>{}"
    "<tr><td colspan=7>* Car 9 set back.</td></tr><tr><td colspan=7>* Provisional results.</td></tr></tbody></table>"
)
ROWS = (
    "<tr><td>1</td><td>44</td><td>Lewis HamiltonHAM</td><td>M</td><td>56</td><td>1:32:03.897</td><td>25</td></tr>"
    "<tr><td>2</td><td>33</td><td>Max VerstappenVER</td><td>R</td><td>56</td><td>+0.745s</td><td>18.5</td></tr>"
    "<tr><td>3</td><td>4</td><td>Lando NorrisNOR</td><td>L</td><td>55</td><td>+1 lap</td><td>15</td></tr>"
    "<tr><td>NC</td><td>9</td><td>Nikita MazepinMAZ</td><td>H</td><td>0</td><td>DNF</td><td>0</td></tr>"
)


@pytest.fixture(scope="module")
def parsed(spark):
    url = f"{ROOT}/2021/races/{{}}/{{}}/race-result"
    races = spark.createDataFrame(
        [(2021, url.format(1, "a"), "N"), (2021, url.format(2, "b"), "N"), (2021, url.format(3, "c"), "N"), (2021, None, "N")],
        "season int, url string, sprint string",
    )
    no_winner = RESULT.format(ROWS.replace("<td>1</td>", "<td>DQ</td>"))
    pages = spark.createDataFrame(
        [
            (1, url.format(1, "a"), "<h1>old</h1>", "2021-01-01"), (2, url.format(1, "a"), RESULT.format(ROWS), "2021-01-02"),
            (3, url.format(2, "b"), no_winner, "2021-01-02"), (4, url.format(3, "c"), "<h1>c</h1>", "2021-01-02"),
            (5, "https://elsewhere.example.org", "<table>", "2021-01-02"),
        ],
        "page_id long, url string, html string, scraped_at_utc string",
    )
    return bronze.parse(weekend.session_plan(races), pages).cache()


def test_results(parsed):
    rows = {r["car_number"]: r for r in bronze.rows_of(parsed, "race-result").filter("race_id = 1").collect()}
    assert rows[44]["race_time_s"] == 5523.897 and rows[44]["gap_to_winner_s"] is None
    assert rows[33]["gap_to_winner_s"] == 0.745 and rows[33]["points"] == 18.5 and rows[33]["driver_name"] == "Max Verstappen"
    assert rows[4]["gap_to_winner_s"] is None and rows[4]["status"] == "Finished"
    assert rows[9]["position"] is None and rows[9]["status"] == "DNF"
    assert rows[44]["event_title"] == "Bahrain 2021" and rows[44]["gp_slug"] == "a" and rows[44]["scraped_at_utc"] == "2021-01-02"
    assert rows[None]["points"] is None


def test_no_winner_no_gaps(parsed):
    rows = bronze.rows_of(parsed, "race-result").filter("race_id = 2").collect()
    assert len(rows) == 6 and all(r["race_time_s"] is None and r["gap_to_winner_s"] is None for r in rows)


def test_errors(parsed):
    found = {r["page_url"]: r["error"] for r in bronze.errors(parsed).collect()}
    assert found[f"{ROOT}/2021/races/3/c/race-result"] == "no result table on the page"
    assert found[f"{ROOT}/2021/races/1/a/practice/3"] == "no page stored for this URL"
    assert f"{ROOT}/2021/races/1/a/race-result" not in found
    assert parsed.count() == 3 * 8


def test_clean_results_and_notes(parsed):
    rows = bronze.rows_of(parsed, "race-result").filter("race_id = 1")
    clean = {r["Car_Number"]: r for r in silver.clean_results(rows).collect()}
    assert len(clean) == 4 and clean[9]["Position"] == "NC" and clean[33]["Driver_Name"] == "Max Verstappen"
    notes = silver.race_notes({"race": rows}).collect()
    assert [n["Note"] for n in notes] == ["Car 9 set back."] and notes[0]["Event"] == "Race"


@pytest.mark.parametrize("season", (2021, 2017, 2004, 1990, 1994, 1975, 2025))
def test_sessions_by_era(spark, season):
    def kinds(sprint):
        races = spark.createDataFrame([(season, f"{ROOT}/{season}/races/1/a/race-result", sprint)], "season int, url string, sprint string")
        return [r["page_url"].split("/a/")[1] for r in weekend.session_plan(races).collect()]

    expected = ["race-result", "starting-grid", "fastest-laps"]
    if season >= 1994:
        expected.append("pit-stop-summary")
    if season < 2006:
        assert kinds("N") == kinds("Y") == [*expected, "qualifying/0"]
        return
    expected += ["qualifying", "practice/1"]
    assert kinds("N") == [*expected, "practice/2", "practice/3"]
    sprint = {2017: [], 2021: ["sprint-grid", "sprint-results"]}.get(season, ["sprint-qualifying", "sprint-grid", "sprint-results"])
    assert kinds("y") == kinds("S") == expected + sprint


def test_season_index_and_sprints(spark):
    index = """<table><tr><th>A</th></tr><tr><td>b</td></tr></table><table><thead><tr><th>Grand Prix</th><th>Date</th></tr></thead><tbody>
        <tr><td><img><span>Flag of B</span><a href="/en/results/2024/races/1/b">Bahrain</a></td><td>02 Mar</td></tr>
        <tr><td><a href="/x">China</a></td><td>21 Apr <a href="/en/results/2024/races/2/c/race-result">more</a></td></tr>
        <tr><td>Nowhere</td></tr></tbody></table>"""
    sprint = "<table><tr><th>Pos.</th><th>Driver</th><th>Q1</th></tr><tr><td>1</td><td>{}</td><td>1:20</td></tr></table>"
    pages = spark.createDataFrame(
        [
            (1, f"{ROOT}/2024/races", index, "t"), (2, f"{ROOT}/2024/races/2/c/sprint-qualifying", sprint.format("A"), "t"),
            (3, f"{ROOT}/2024/races/1/b/sprint-results", sprint.format(""), "t"),
        ],
        "page_id long, url string, html string, scraped_at_utc string",
    )
    rows = [tuple(r) for r in bronze.list_races(pages).orderBy("gp").collect()]
    assert rows == [
        (2024, "Bahrain", "02 Mar", f"{ROOT}/2024/races/1/b/race-result", "N", "t", "", "", 1),
        (2024, "China", "21 Apr more", f"{ROOT}/2024/races/2/c/race-result", "Y", "t", "", "", 2),
        (2024, "Nowhere", None, None, "N", "t", "", "", None),
    ]


def test_practice_with_separate_columns(spark):
    page = "<h2>P</h2><table><tr><th>Position</th><th>Car no.</th><th>Driver</th><th>Best time</th><th>Gap</th><th>Interval</th><th>Laps</th></tr>"
    page += "<tr><td>1</td><td>5</td><td>A B</td><td>1:20.5</td><td></td><td>-</td><td>9</td></tr>"
    page += "<tr><td>2</td><td>6</td><td>C D</td><td>no time</td><td>+0.5</td><td>+0.5s</td><td>9.0</td></tr></table>"
    url = f"{ROOT}/2010/races/1/a"
    races = spark.createDataFrame([(2010, url + "/race-result", "N")], "season int, url string, sprint string")
    pages = spark.createDataFrame([(1, url + "/practice/1", page, "t")], "page_id long, url string, html string, scraped_at_utc string")
    rows = bronze.rows_of(bronze.parse(weekend.session_plan(races), pages), "practice").orderBy("position")
    got = rows.select("time", "time_s", "gap_s", "interval_s", "laps", "practice_no", "team").collect()
    assert [tuple(r) for r in got] == [("1:20.5", 80.5, None, None, 9, 1, None), ("no time", None, 0.5, 0.5, 9, 1, None)]
    base = silver.clean_practices(rows).orderBy("Position").select("Base_time_s", "Real_time_s", "Practice").collect()
    assert [tuple(r) for r in base] == [(80.5, 80.5, "Practice 1"), (80.5, 81.0, "Practice 1")]
    assert rows.filter(F.col("season") != 2010).count() == 0
