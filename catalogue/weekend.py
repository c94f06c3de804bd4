"""A whole run: pages of several kinds stored, parsed once, split into tables, cleaned, promoted, noted and reported."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import Tables, query
from catalogue.bronze import GRID, QUALIFYING, RESULT, _ORDERS, _page, _race_url
from racelake.operators.shape import union_all
from racelake.plans import bronze, silver, weekend
from racelake.sources import pages as page_store
from racelake.sources import staging, stored

c = F.col

SEASON = 2024
KINDS = {"race-result": RESULT, "qualifying": QUALIFYING, "starting-grid": GRID}

_TEAM = "CASE WHEN i = 2 THEN NULL ELSE 'Team ' || o_orderpriority END"


def _result_rows(kind: str, position: str) -> str:
    return f"""SELECT '{kind}' AS kind, CAST(o_orderkey AS INTEGER) AS race_id, {position} AS position, 'Ann Lee ' || i AS driver, {_TEAM} AS team, CAST(NULL AS VARCHAR) AS note
        FROM (SELECT *, unnest(generate_series(1, n)) AS i FROM o)"""


@query(
    "weekend_job",
    f"""
    {_result_rows("race-result", "CASE WHEN i = n THEN 'NC' WHEN i = 1 AND o_orderstatus = 'P' THEN 'DQ' ELSE CAST(i AS VARCHAR) END")}
    UNION ALL {_result_rows("qualifying", "CAST(i AS VARCHAR)")}
    UNION ALL {_result_rows("starting-grid", "CAST(i AS VARCHAR)")}
    UNION ALL SELECT event, CAST(o_orderkey AS INTEGER), NULL, NULL, NULL, 'Car ' || o_custkey || ' set back.'
    FROM o, (VALUES ('Race'), ('Qualifying'), ('Starting Grid')) AS v(event)
    UNION ALL SELECT 'errors', NULL, NULL, NULL, NULL, 'no page stored for this URL ' || count(*) FROM o
    """,
    o=_ORDERS,
)
def weekend_job(t: Tables):
    """From stored pages to clean tables and their notes; fastest laps were never scraped and are reported as missing."""
    races = t(f"SELECT {SEASON} AS season, {_race_url(SEASON)} AS url, 'S' AS sprint, 'N' AS bronze FROM {{orders}}", spread=True)
    plan = weekend.session_plan(weekend.worklist(races, SEASON)).filter(c("kind").isin(*KINDS, "fastest-laps"))
    store = page_store.store(
        union_all(
            t(
                f"""SELECT o_orderkey * 4 + {n} AS page_id, replace({_race_url(SEASON)}, 'race-result', '{kind}') AS url,
                           {_page(cells)} AS html, '2024-05-01T00:00:00' AS scraped_at_utc FROM ({_ORDERS}) AS o""",
                spread=True,
            )
            for n, (kind, cells) in enumerate(KINDS.items())
        ),
        staging.table_name("pages"),
    )
    # the only step with markup or Python; all tables, notes and errors are taken from its result
    parsed = staging.staged(bronze.parse_stored(plan, store), "parsed-pages", ["kind"])
    tables = {}
    for kind in KINDS:  # bronze tables, promoted twice into a base of seasons: the second time adds nothing
        rows = staging.staged(bronze.rows_of(parsed, kind), kind)
        tables[kind] = staging.table_name(kind.replace("-", "_"))
        stored.create(rows.filter(F.lit(False)), tables[kind], ["season"])
        for _ in range(2):
            stored.promote_into(t.spark, tables[kind], rows, ["race_id"])
    results, qualifying, grid = (t.spark.table(name) for name in tables.values())
    clean = {
        "race-result": silver.clean_results(results).select("Race_Id", "Position", "Driver_Name", "Team"),
        "qualifying": silver.clean_qualifying(qualifying).select("Race_Id", "Position", "Driver_Name", "Team"),
        "starting-grid": silver.clean_grid(grid).select("Race_Id", c("Grid_Position").cast("string").alias("Position"), "Driver_Name", "Team"),
    }
    out = [
        df.select(
            F.lit(kind).alias("kind"), c("Race_Id").alias("race_id"), c("Position").alias("position"), c("Driver_Name").alias("driver"),
            c("Team").alias("team"),
        )
        for kind, df in clean.items()
    ]
    notes = silver.race_notes({"race": results, "qualifying": qualifying, "grid": grid})
    out.append(notes.select(c("Event").alias("kind"), c("Race_Id").alias("race_id"), c("Note").alias("note")))
    problems = bronze.errors(parsed).groupBy("error").count()
    out.append(problems.select(F.lit("errors").alias("kind"), F.concat_ws(" ", "error", c("count").cast("string")).alias("note")))
    return union_all(out)
