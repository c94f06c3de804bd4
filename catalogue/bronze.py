"""Result pages built from the orders, stored, looked up, parsed and turned into bronze rows.

The stored test pages hold no tables, so every order becomes a page with one: a few rows by rule
from the order itself, no rows of different orders on one page. The SQL computes the same rows
without any page.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import Tables, query
from racelake.plans import bronze, weekend
from racelake.sources import html, staging
from racelake.sources import pages as page_store

c = F.col

_NOTE = "'* Car ' || o_custkey || ' set back. *'"

# cells of row i of n; the header of each column is its key
RESULT = {
    "Pos.": "CASE WHEN i = n OR (i = 1 AND o_orderstatus = 'P') THEN 'NC' ELSE CAST(i AS STRING) END",
    "No.": "CAST(o_custkey % 90 + i AS STRING)",
    "Driver": "'Ann' || chr(160) || 'Lee ' || i || 'ABC'",
    "Team": "CASE WHEN i = 2 THEN '' ELSE 'Team ' || o_orderpriority END",
    "Laps": "CAST(50 - i AS STRING)",
    "Time / Retired": "CASE WHEN i = 1 THEN '1:3' || (o_custkey % 10) || ':07.25' WHEN i = n THEN 'DNF' WHEN i = 4 THEN '+1 lap' ELSE '+' || i || '.5s' END",
    "Pts.": "CASE WHEN i = 1 THEN '12.5' ELSE CAST(10 - i AS STRING) END",
}
SPRINT = RESULT | {"Pts.": "CAST(10 - i AS STRING)"}
QUALIFYING = {
    "Pos.": "CAST(i AS STRING)", "No.": RESULT["No."], "Driver": RESULT["Driver"], "Team": RESULT["Team"],
    "Q1": "'1:2' || (i % 10) || '.125'", "Q2": "CASE WHEN i > 2 THEN 'DNF' ELSE '1:1' || i || '.5' END",
    "Q3": "CASE WHEN i > 1 THEN '' ELSE '59.75' END", "Laps": "CAST(o_custkey % 20 AS STRING)",
}
OLD_QUALIFYING = {
    "Pos.": QUALIFYING["Pos."], "Number": RESULT["No."], "Driver": "'Ann Lee ' || i", "Team": RESULT["Team"],
    "Best Time": "CASE WHEN i = n THEN 'no time' ELSE '1:2' || (i % 10) || '.125' END",
}
GRID = {
    "Pos.": QUALIFYING["Pos."], "No.": RESULT["No."], "Driver": RESULT["Driver"], "Team": RESULT["Team"],
    "Time": "CASE WHEN i = n THEN '' ELSE '1:2' || (i % 10) || '.125' END",
}
FASTEST_LAPS = {
    "Pos.": QUALIFYING["Pos."], "No.": RESULT["No."], "Driver": RESULT["Driver"], "Team": RESULT["Team"],
    "Lap": "CAST(o_custkey % 60 AS STRING)", "Time of day": "'14:0' || (i % 10) || ':00'", "Time": QUALIFYING["Q1"],
    "Avg Speed": "CASE WHEN i = n THEN '-' ELSE '21' || (i % 10) || ',5 km/h' END",
}
PIT_STOPS = {
    "Stops": "CAST(i AS STRING)", "No.": RESULT["No."], "Driver": RESULT["Driver"], "Team": RESULT["Team"],
    "Lap": FASTEST_LAPS["Lap"], "Time of day": FASTEST_LAPS["Time of day"], "Time": "'2' || (i % 10) || '.25'",
    "Total": "CASE WHEN i = n THEN '1:00:0' || (i % 10) || '.5' ELSE '1:0' || (i % 10) || '.5' END",
}
PRACTICE = {
    "Pos.": QUALIFYING["Pos."], "No.": RESULT["No."], "Driver": RESULT["Driver"], "Team": RESULT["Team"],
    "Time / Gap": "CASE WHEN i = 1 THEN '1:2' || (o_custkey % 10) || '.5' WHEN i = n THEN '' ELSE '+' || i || '.125s' END",
    "Laps": "CAST(o_custkey % 40 AS STRING)",
}

_ORDERS = "SELECT *, 3 + o_orderkey % 4 AS n FROM {orders}"


def _race_url(season: int) -> str:
    return f"'https://results.example.org/en/results/{season}/races/' || o_orderkey || '/gp-' || o_custkey || '/race-result'"


def _page(cells: dict[str, str]) -> str:
    """A page as a Spark SQL expression: heading, a table of another kind, the table, a footnote."""
    heads = "".join(f"<th> {h}</th>" for h in cells)
    row = ", ".join(f"'<td>', coalesce({cell}, ''), '</td>'" for cell in cells.values())
    rows = f"array_join(transform(sequence(1, CAST(n AS INT)), i -> concat('<tr>', {row}, '</tr>')), '')"
    note = f"'<tr><td colspan=\"{len(cells)}\">', {_NOTE}, '</td></tr>'"
    return (
        "concat('<html><!-- <h1>no</h1> --><body><h1>GP <b>', o_custkey, '</b> &amp; more</h1><table><tr><th>A</th></tr>"
        f"<tr><td>b</td></tr></table><table><thead><tr>{heads}</tr></thead><tbody>', {rows}, {note}, '</tbody></table></body></html>')"
    )


def _stored(t: Tables, kind: str, cells: dict[str, str], season: int, sprint: str, numbers: tuple[int, ...] = (0,)):
    """The session plan for one kind of page (all numbers of it), and a store with those pages and stale copies."""
    races = t(f"SELECT {season} AS season, {_race_url(season)} AS url, '{sprint}' AS sprint FROM {{orders}}", spread=True)
    plan = weekend.session_plan(races).filter(c("kind") == kind)
    path = {"old-qualifying": "'qualifying/0'", "practice": "'practice/' || number"}.get(kind, f"'{kind}'")
    every = f"LATERAL VIEW explode(array({', '.join(map(str, numbers))})) AS number"
    pages = t(
        f"""
        SELECT o_orderkey * 8 + 2 * number AS page_id, replace({_race_url(season)}, 'race-result', {path}) AS url, {_page(cells)} AS html,
               '2024-05-01T00:00:00' AS scraped_at_utc FROM ({_ORDERS}) AS o {every}
        UNION ALL
        SELECT o_orderkey * 8 + 2 * number + 1, replace({_race_url(season)}, 'race-result', {path}), '<h1>Stale</h1><table><tr><td>1</td></tr></table>',
               '2024-04-01T00:00:00' FROM {{orders}} {every} WHERE o_orderstatus = 'F'
        """,
        spread=True,
    )
    return plan, pages


def _rows(cells: dict[str, str], names: list[str], season: int, path: str) -> str:
    """The same rows as a DuckDB query, with cells as stored text and lineage."""
    texts = ", ".join(f"nullif({cell}, '') AS {name}" for cell, name in zip(cells.values(), names))
    notes = ", ".join(f"{_NOTE} AS {name}" for name in names)
    lineage = f"""replace({_race_url(season)}, 'race-result', '{path}') AS source_url, 'GP ' || o_custkey || ' & more' AS event_title,
        '2024-05-01T00:00:00' AS scraped_at_utc, CAST(o_orderkey AS INTEGER) AS race_id, 'gp-' || o_custkey AS gp_slug,
        CAST({season} AS INTEGER) AS season"""
    return f"""SELECT i, n, o_orderstatus, {texts}, {lineage} FROM (SELECT *, unnest(generate_series(1, n)) AS i FROM ({_ORDERS}))
        UNION ALL SELECT 0, n, o_orderstatus, {notes}, {lineage} FROM ({_ORDERS})"""


_INT = "TRY_CAST({0} AS INTEGER) AS {0}"
_LINEAGE = "source_url, event_title, scraped_at_utc, race_id, gp_slug, season"
_NAMES = """CASE WHEN driver LIKE '%ABC' THEN trim(regexp_replace(driver, 'ABC$', '')) ELSE driver END AS driver_name,
    CASE WHEN driver LIKE '%ABC' THEN 'ABC' END AS driver_code"""


def _mss(cell: str) -> str:
    """Seconds of ``M:SS.f``, ``SS.f`` or ``+SS.fs`` cells, null for words."""
    body = f"rtrim(ltrim({cell}, '+'), 's')"
    return f"""CASE WHEN {cell} LIKE '%:%:%' THEN TRY_CAST(split_part({cell}, ':', 1) AS DOUBLE) * 3600
            + TRY_CAST(split_part({cell}, ':', 2) AS DOUBLE) * 60 + TRY_CAST(split_part({cell}, ':', 3) AS DOUBLE)
        WHEN {cell} LIKE '%:%' THEN TRY_CAST(split_part({cell}, ':', 1) AS DOUBLE) * 60 + TRY_CAST(split_part({cell}, ':', 2) AS DOUBLE)
        ELSE TRY_CAST({body} AS DOUBLE) END"""


def _results_sql(points: str) -> str:
    return f"""
    SELECT {_INT.format("position")}, {_INT.format("car_number")}, driver, team, {_INT.format("laps")}, time_or_retired,
           TRY_CAST(points AS {points}) AS points, {_NAMES}, CASE WHEN time_or_retired = 'DNF' THEN 'DNF' ELSE 'Finished' END AS status,
           CASE WHEN position = '1' THEN {_mss("time_or_retired")} END AS race_time_s,
           CASE WHEN o_orderstatus <> 'P' AND position <> '1' AND time_or_retired LIKE '+%' THEN {_mss("time_or_retired")} END AS gap_to_winner_s,
           {_LINEAGE}
    FROM src
    """


_RESULT_NAMES = ["position", "car_number", "driver", "team", "laps", "time_or_retired", "points"]


def _bronze(t: Tables, kind: str, cells: dict[str, str], season: int = 2024, sprint: str = "Y", numbers: tuple[int, ...] = (0,)):
    """The rows of all pages of a kind, from a page store bucketed by URL."""
    plan, pages = _stored(t, kind, cells, season, sprint, numbers)
    store = page_store.store(pages, staging.table_name("pages"))
    return bronze.rows_of(bronze.parse_stored(plan, store), kind)


@query("results_from_pages", _results_sql("DOUBLE"), src=_rows(RESULT, _RESULT_NAMES, 2024, "race-result"))
def results_from_pages(t: Tables):
    return _bronze(t, "race-result", RESULT)


@query("sprint_from_pages", _results_sql("INTEGER"), src=_rows(SPRINT, _RESULT_NAMES, 2024, "sprint-results"))
def sprint_from_pages(t: Tables):
    return _bronze(t, "sprint-results", SPRINT)


_QUALIFYING_SQL = f"""
    SELECT {_INT.format("position")}, {_INT.format("car_number")}, driver, team, q1, q2, q3, {_INT.format("laps")},
           {_mss("q1")} AS "Q1_Segs", {_mss("q2")} AS "Q2_Segs", {_mss("q3")} AS "Q3_Segs", {_NAMES}, {_LINEAGE}
    FROM src
"""
_QUALIFYING_NAMES = ["position", "car_number", "driver", "team", "q1", "q2", "q3", "laps"]


@query("qualifying_from_pages", _QUALIFYING_SQL, src=_rows(QUALIFYING, _QUALIFYING_NAMES, 2024, "qualifying"))
def qualifying_from_pages(t: Tables):
    return _bronze(t, "qualifying", QUALIFYING)


@query("sprint_qualifying_from_pages", _QUALIFYING_SQL, src=_rows(QUALIFYING, _QUALIFYING_NAMES, 2024, "sprint-qualifying"))
def sprint_qualifying_from_pages(t: Tables):
    return _bronze(t, "sprint-qualifying", QUALIFYING)


@query(
    "old_qualifying_from_pages",
    f"""
    SELECT {_INT.format("position")}, {_INT.format("car_number")}, driver, team, time, {_mss("time")} AS time_s,
           CAST(NULL AS INTEGER) AS laps, CAST(NULL AS INTEGER) AS points, {_NAMES}, {_LINEAGE}
    FROM src
    """,
    src=_rows(OLD_QUALIFYING, ["position", "car_number", "driver", "team", "time"], 1995, "qualifying/0"),
)
def old_qualifying_from_pages(t: Tables):
    return _bronze(t, "old-qualifying", OLD_QUALIFYING, season=1995)


_GRID_SQL = f"""
    SELECT TRY_CAST(grid_position AS INTEGER) AS grid_position, {_INT.format("car_number")}, driver, team, time_or_note,
           CAST(NULL AS INTEGER) AS points, {_NAMES}, {_LINEAGE}
    FROM src
"""
_GRID_NAMES = ["grid_position", "car_number", "driver", "team", "time_or_note"]


@query("grid_from_pages", _GRID_SQL, src=_rows(GRID, _GRID_NAMES, 2024, "starting-grid"))
def grid_from_pages(t: Tables):
    return _bronze(t, "starting-grid", GRID)


@query("sprint_grid_from_pages", _GRID_SQL, src=_rows(GRID, _GRID_NAMES, 2024, "sprint-grid"))
def sprint_grid_from_pages(t: Tables):
    return _bronze(t, "sprint-grid", GRID)


@query(
    "fastlap_from_pages",
    f"""
    SELECT {_INT.format("position")}, {_INT.format("car_number")}, driver, team, {_INT.format("lap")}, lap_time,
           {_mss("lap_time")} AS lap_time_s, CAST(NULL AS VARCHAR) AS gap, CAST(NULL AS DOUBLE) AS gap_s,
           TRY_CAST(nullif(regexp_extract(replace(speed, ',', '.'), '[-+]?[0-9]+([.][0-9]+)?'), '') AS DOUBLE) AS avg_speed_kph,
           CAST(NULL AS INTEGER) AS points, {_NAMES}, {_LINEAGE}
    FROM src
    """,
    src=_rows(FASTEST_LAPS, ["position", "car_number", "driver", "team", "lap", "time_of_day", "lap_time", "speed"], 2024, "fastest-laps"),
)
def fastlap_from_pages(t: Tables):
    return _bronze(t, "fastest-laps", FASTEST_LAPS)


@query(
    "pit_from_pages",
    f"""
    SELECT {_INT.format("stop")}, {_INT.format("car_number")}, driver, team, {_INT.format("lap")}, time_of_day, pit_time,
           {_mss("pit_time")} AS pit_secs, total_time, {_mss("total_time")} AS total_secs, {_NAMES}, {_LINEAGE}
    FROM src
    """,
    src=_rows(PIT_STOPS, ["stop", "car_number", "driver", "team", "lap", "time_of_day", "pit_time", "total_time"], 2024, "pit-stop-summary"),
)
def pit_from_pages(t: Tables):
    return _bronze(t, "pit-stop-summary", PIT_STOPS)


@query(
    "practice_from_pages",
    f"""
    SELECT {_INT.format("position")}, {_INT.format("car_number")}, driver, team, CASE WHEN cell NOT LIKE '+%' THEN cell END AS time,
           CASE WHEN cell NOT LIKE '+%' THEN {_mss("cell")} END AS time_s, CASE WHEN cell LIKE '+%' THEN cell END AS gap,
           CASE WHEN cell LIKE '+%' THEN {_mss("cell")} END AS gap_s, CAST(NULL AS VARCHAR) AS "interval", CAST(NULL AS DOUBLE) AS interval_s,
           {_INT.format("laps")}, {_NAMES}, {_LINEAGE}, practice_no
    FROM src
    """,
    src=" UNION ALL ".join(
        f"SELECT *, CAST({n} AS INTEGER) AS practice_no FROM ("
        + _rows(PRACTICE, ["position", "car_number", "driver", "team", "cell", "laps"], 2024, f"practice/{n}") + ")"
        for n in (1, 2, 3)
    ),
)
def practice_from_pages(t: Tables):
    """The three practice sessions of every race."""
    return _bronze(t, "practice", PRACTICE, sprint="N", numbers=(1, 2, 3))


@query(
    "page_errors",
    f"""
    SELECT {_race_url(2024)} AS page_url, CASE o_orderpriority WHEN '5-LOW' THEN 'no page stored for this URL'
           ELSE 'no result table on the page' END AS error
    FROM orders WHERE o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW')
    """,
)
def page_errors(t: Tables):
    """Planned pages that are not stored, or hold no result table."""
    plan, pages = _stored(t, "race-result", RESULT, 2024, "N")
    kept = t("SELECT o_orderkey * 8 AS page_id, o_orderpriority FROM {orders} WHERE o_orderpriority <> '5-LOW'")
    broken = F.when(c("o_orderpriority") == "4-NOT SPECIFIED", "<h1>Sorry</h1><table><tr><td>1</td></tr></table>")
    store = pages.join(kept, "page_id").withColumn("html", F.coalesce(broken, c("html")))
    return bronze.errors(bronze.parse(plan, store))


@query(
    "table_round_trip",
    """
    SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_partkey AS INTEGER) AS l_partkey, CAST(l_linenumber AS INTEGER) AS l_linenumber,
           l_quantity, l_extendedprice, l_returnflag, CAST(1 AS INTEGER) AS row_no
    FROM lineitem
    """,
)
def table_round_trip(t: Tables):
    """Every line item written as a one-row table and read back."""
    columns = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"]
    heads = "".join(f"<th>{n.upper()}</th>" for n in columns)
    cells = [x for n in columns for x in (F.lit("<td>"), c(n).cast("string"), F.lit("</td>"))]
    pages = t("SELECT * FROM {lineitem}", spread=True).select(
        F.concat(F.lit(f"<table><tr>{heads}</tr><tr>"), *cells, F.lit("</tr></table>")).alias("html")
    )
    table = F.get("tables", F.lit(0))
    rows = html.extract_tables(pages, []).select(
        table["headers"].alias("headers"), F.posexplode(table["rows"]).alias("row_no", "row")
    )
    named = F.map_from_arrays(F.transform("headers", F.lower), "row.cells")
    kinds = dict(zip(columns, ["int", "int", "int", "double", "double", "string"]))
    return rows.select(
        *(named[n].try_cast(kinds[n]).alias(n) for n in columns),
        (c("row_no") + 1).alias("row_no"),
    )


_INDEX_ROW = """concat('<tr><td><img alt="flag"/><span>Flag of X</span><a href="/en/results/', o_orderkey, '/races/', o_orderkey * 10 + i,
    '/gp-', i, CASE WHEN i = 2 THEN '' ELSE '/race-result' END, '">GP <i>', i, '</i></a></td><td>', i, ' Mar</td></tr>')"""


def _index_pages(t: Tables):
    """A season index for every order, with three races and their sprint pages."""
    url = "'https://results.example.org/en/results/' || o_orderkey || '/races'"
    sprint_table = "<table><tr><th>Pos.</th><th>Driver</th><th>Laps</th></tr><tr><td>1</td><td>{}</td><td>9</td></tr></table>"
    return t(
        f"""
        SELECT o_orderkey * 10 AS page_id, {url} AS url, '2024-05-01T00:00:00' AS scraped_at_utc,
               concat('<h1>Races</h1><table><thead><tr><th>Grand Prix</th><th>Date</th></tr></thead><tbody>',
                      array_join(transform(sequence(1, 3), i -> {_INDEX_ROW}), ''), '</tbody></table>') AS html
        FROM {{orders}}
        UNION ALL SELECT o_orderkey * 10 + 1, {url} || '/' || (o_orderkey * 10 + 1) || '/gp-1/sprint-results', '2024-05-01T00:00:00',
               '{sprint_table.format("Ann")}' FROM {{orders}}
        UNION ALL SELECT o_orderkey * 10 + 2, {url} || '/' || (o_orderkey * 10 + 2) || '/gp-2/sprint-qualifying', '2024-05-01T00:00:00',
               'NO results available {sprint_table.format("Ann")}' FROM {{orders}}
        UNION ALL SELECT o_orderkey * 10 + 3, {url} || '/' || (o_orderkey * 10 + 3) || '/gp-3/sprint-grid', '2024-05-01T00:00:00',
               '{sprint_table.format("")}' FROM {{orders}}
        """,
        spread=True,
    )


@query(
    "races_from_index",
    """
    SELECT CAST(o_orderkey AS INTEGER) AS season, 'GP ' || i AS gp, i || ' Mar' AS date_text,
           'https://results.example.org/en/results/' || o_orderkey || '/races/' || (o_orderkey * 10 + i) || '/gp-' || i || '/race-result' AS url,
           CASE WHEN i = 1 THEN 'Y' ELSE 'N' END AS sprint, '2024-05-01T00:00:00' AS scraped_at_utc, '' AS silver, '' AS bronze,
           CAST(o_orderkey * 10 + i AS INTEGER) AS race_id
    FROM (SELECT o_orderkey, unnest([1, 2, 3]) AS i FROM orders)
    """,
)
def races_from_index(t: Tables):
    """The races of all season index pages, sprints told by their own pages."""
    return bronze.list_races(_index_pages(t))


@query(
    "sprint_flag",
    """
    SELECT 'https://results.example.org/en/results/' || o_orderkey || '/races/' || (o_orderkey * 10 + i) || '/gp-' || i || '/race-result' AS race_url,
           i = 1 AS has_sprint
    FROM (SELECT o_orderkey, unnest([1, 2, 3]) AS i FROM orders)
    """,
)
def sprint_flag(t: Tables):
    """Races with sprint pages, and whether any of these shows results."""
    pages = _index_pages(t)
    return bronze.sprint_races(staging.staged(bronze.season_races(pages), "season-races"), pages)
