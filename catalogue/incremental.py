"""Schemas, work lists, session plan, new rows and promotion."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import Tables, query
from racelake import schemas
from racelake.functions import text
from racelake.operators import lookups, shape
from racelake.plans import weekend

c = F.col


@query(
    "rename_cast",
    """
    SELECT CAST(o_orderkey AS INTEGER) AS "Race_Id", TRY_CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS "Priority",
           TRY_CAST(o_orderpriority AS INTEGER) AS "Position", CAST(o_totalprice AS VARCHAR) AS "Time",
           o_totalprice AS "Points", o_orderstatus AS "Status"
    FROM orders
    """,
)
def rename_cast(t: Tables):
    """Rename, reorder and prune by a mapping, then cast; what does not fit becomes null."""
    wide = t.orders.withColumn("priority", F.split_part("o_orderpriority", F.lit("-"), F.lit(1))).drop("o_custkey")
    mapping = {
        "o_orderkey": "Race_Id", "priority": "Priority", "o_orderpriority": "Position", "price_text": "Time",
        "o_totalprice": "Points", "o_orderstatus": "Status",
    }
    renamed = shape.rename(wide.withColumn("price_text", c("o_totalprice")), mapping)
    return shape.cast_to(
        renamed, "Race_Id int, Priority int, Position int, Time string, Points double, Status string"
    )


# numbers as dirty text
DIRTY = """
SELECT p_partkey, p_name, p_size AS extra, CASE CAST(p_partkey % 5 AS INT)
    WHEN 0 THEN CAST(p_size AS STRING) WHEN 1 THEN CAST(p_size AS STRING) || '.0' WHEN 2 THEN 'NC'
    WHEN 3 THEN ' ' || CAST(p_size AS STRING) || chr(160) ELSE '' END AS position,
    CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS STRING) || '.25' ELSE 'n/a' END AS points
FROM {part}
"""


@query(
    "conform_schema",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CAST(NULL AS VARCHAR) AS team,
           CAST(TRY_CAST(trim(position, ' ' || chr(160)) AS DOUBLE) AS INTEGER) AS position,
           TRY_CAST(points AS DOUBLE) AS points, CAST(NULL AS INTEGER) AS laps
    FROM src
    """,
    src=DIRTY,
)
def conform_schema(t: Tables):
    """Missing columns, an extra one and dirty numbers brought into a fixed schema."""
    return shape.conform(
        t(DIRTY), "p_partkey string, p_name string, team string, position int, points double, laps int"
    )


@query(
    "type_migration",
    """SELECT CAST(p_partkey AS BIGINT) AS p_partkey, CAST(p_size AS DOUBLE) AS p_size, p_name FROM part""",
)
def type_migration(t: Tables):
    """A table moved to a schema in which a whole number becomes a fraction."""
    return shape.conform(t.part, "p_partkey bigint, p_size double, p_name string")


# result rows among footnotes, which have no laps
WITH_NOTES = """
SELECT CAST(l_orderkey AS INT) AS race_id, l_partkey, l_linenumber, CAST(2005 + l_orderkey % 20 AS INT) AS season,
       'gp-' || CAST(l_suppkey AS STRING) AS gp_slug,
       CASE WHEN l_quantity > 45 THEN NULL ELSE CAST(l_quantity AS INT) END AS laps,
       CASE WHEN l_quantity <= 45 THEN 'Driver ' || CAST(l_partkey AS STRING)
            WHEN l_linenumber = 1 THEN '* Provisional results.'
            WHEN l_linenumber = 2 THEN NULL
            WHEN l_linenumber = 3 THEN 'Error 404'
            ELSE '* Car ' || CAST(l_suppkey AS STRING) || ' set back *' END AS driver,
       CASE WHEN l_quantity <= 45 THEN 'Driver ' || CAST(l_partkey AS STRING)
            ELSE '* Car ' || CAST(l_suppkey AS STRING) || ' set back *' END AS driver_name
FROM {lineitem}
"""


@query(
    "split_data",
    "SELECT race_id, l_partkey, l_linenumber, laps, driver FROM src WHERE laps IS NOT NULL",
    src=WITH_NOTES,
)
def split_data(t: Tables):
    data, _ = shape.split_rows(t(WITH_NOTES), c("laps").isNotNull())
    return data.select("race_id", "l_partkey", "l_linenumber", "laps", "driver")


@query(
    "split_notes",
    """
    SELECT race_id, l_partkey, l_linenumber, driver FROM src WHERE laps IS NULL AND driver <> '* Provisional results.'
        AND NOT contains(driver, 'Error')
    """,
    src=WITH_NOTES,
)
def split_notes(t: Tables):
    _, rest = shape.split_rows(t(WITH_NOTES), c("laps").isNotNull())
    kept = rest.filter((c("driver") != "* Provisional results.") & ~c("driver").contains("Error"))
    return kept.select("race_id", "l_partkey", "l_linenumber", "driver")


@query(
    "notes_union",
    """
    SELECT trim(replace(driver_name, '*', '')) AS "Note", race_id AS "Race_Id", season AS "Season", gp_slug AS "Gp_Slug", event AS "Event"
    FROM src, (VALUES ('Race', false), ('Qualifying', false), ('Old Qualifying', true)) AS v(event, strict)
    WHERE laps IS NULL AND driver <> '* Provisional results.' AND NOT (strict AND contains(driver, 'Error'))
    """,
    src=WITH_NOTES,
)
def notes_union(t: Tables):
    """The footnotes of three sessions in one table, tagged by session."""
    rows = t(WITH_NOTES)
    return shape.union_all(
        [
            shape.notes(rows, "laps", "Race"),
            shape.notes(rows, "laps", "Qualifying"),
            shape.notes(rows, "laps", "Old Qualifying", drop_broken=True),
        ]
    )


@query(
    "practice_union",
    """
    SELECT l_orderkey, l_partkey, l_linenumber, CAST(no AS INTEGER) AS practice_no, 'Practice ' || no AS "Practice",
           CASE WHEN no < 3 THEN l_quantity END AS l_quantity
    FROM lineitem JOIN (VALUES ('A', 1), ('N', 2), ('R', 3)) AS v(flag, no) ON flag = l_returnflag
    """,
)
def practice_union(t: Tables):
    """Three practice tables as one; the third lacks a column."""
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag")
    parts = {n: rows.filter(c("l_returnflag") == f).drop("l_returnflag") for n, f in enumerate("ANR", 1)}
    parts[3] = parts[3].drop("l_quantity")
    return shape.practices(parts)


# orders as races of all eras
RACES = """
SELECT o_orderkey, CAST(1970 + o_orderkey % 61 AS INT) AS season, CASE o_orderstatus WHEN 'F' THEN 'Y' WHEN 'O' THEN 'n' ELSE 's' END AS sprint,
       CASE o_orderpriority WHEN '5-LOW' THEN 'Y' ELSE 'N' END AS bronze,
       CASE WHEN o_orderkey % 10 = 9 THEN NULL
            ELSE 'https://results.example.org/en/results/' || CAST(1970 + o_orderkey % 61 AS STRING) || '/races/'
                 || CAST(o_orderkey AS STRING) || '/gp-' || CAST(o_custkey AS STRING) || '/race-result' END AS url
FROM {orders}
"""


@query(
    "worklist",
    """
    SELECT o_orderkey, upper(sprint) IN ('Y', 'S') AS is_sprint, upper(sprint) = 'N' AND url IS NOT NULL AS full_practice
    FROM src WHERE season = 2024 AND bronze = 'N'
    """,
    src=RACES,
)
def worklist(t: Tables):
    """The unprocessed races of a season."""
    todo = weekend.worklist(t(RACES), 2024)
    return todo.select(
        "o_orderkey", weekend.is_sprint(c("sprint")).alias("is_sprint"),
        (weekend.has_full_practice(c("sprint")) & c("url").isNotNull()).alias("full_practice"),
    )


@query(
    "session_plan",
    """
    SELECT season, url AS race_url, kind, practice_no, regexp_replace(url, '/[^/]*$', '') || '/' || path AS page_url
    FROM src JOIN (VALUES
        ('race-result', 'race-result', NULL, 0, 9999, 'any'), ('starting-grid', 'starting-grid', NULL, 0, 9999, 'any'),
        ('fastest-laps', 'fastest-laps', NULL, 0, 9999, 'any'), ('pit-stop-summary', 'pit-stop-summary', NULL, 1994, 9999, 'any'),
        ('old-qualifying', 'qualifying/0', NULL, 0, 2005, 'any'), ('qualifying', 'qualifying', NULL, 2006, 9999, 'any'),
        ('practice', 'practice/1', 1, 2006, 9999, 'any'), ('practice', 'practice/2', 2, 2006, 9999, 'plain'),
        ('practice', 'practice/3', 3, 2006, 9999, 'plain'), ('sprint-qualifying', 'sprint-qualifying', NULL, 2023, 9999, 'sprint'),
        ('sprint-grid', 'sprint-grid', NULL, 2021, 9999, 'sprint'), ('sprint-results', 'sprint-results', NULL, 2021, 9999, 'sprint')
    ) AS v(kind, path, practice_no, first_season, last_season, weekend)
      ON season BETWEEN first_season AND last_season
         AND (weekend = 'any' OR (weekend = 'sprint' AND upper(sprint) IN ('Y', 'S')) OR (weekend = 'plain' AND upper(sprint) = 'N'))
    WHERE url IS NOT NULL
    """,
    src=RACES,
)
def session_plan(t: Tables):
    """Every session page of every race, by era and sprint flag."""
    return weekend.session_plan(t(RACES))


# the races seen now, and those the master table lists (a part of them, with copies)
STAGED = """
SELECT CAST(year(o_orderdate) AS INT) AS season, 'gp-' || CAST(o_custkey AS STRING) AS gp, CAST(o_orderkey AS STRING) AS date_text,
       CAST(o_orderkey AS STRING) AS url, o_orderstatus AS sprint, o_orderpriority AS scraped_at_utc, '' AS silver, '' AS bronze,
       CAST(o_orderkey AS INT) AS race_id
FROM {orders}
"""
KNOWN = """
SELECT CAST(year(o_orderdate) AS INT) AS season, 'gp-' || CAST(o_custkey AS STRING) AS gp,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Y' WHEN '2-HIGH' THEN 'N' ELSE NULL END AS bronze
FROM {orders} WHERE o_orderstatus = 'F'
"""
_FLAG = "CASE WHEN EXISTS (FROM known k WHERE k.season = s.season AND k.gp = s.gp AND k.bronze = 'Y') THEN 'Y' ELSE 'N' END"


@query(
    "carried_flags",
    f"""
    SELECT s.season, s.gp, date_text, url, sprint, scraped_at_utc, 'N' AS silver, {_FLAG} AS bronze, race_id FROM staged s
    """,
    staged=STAGED, known=KNOWN,
)
def carried_flags(t: Tables):
    """The staged races with the processing flag of the master table."""
    return lookups.register_races(t(STAGED), t(KNOWN)).staged


@query(
    "new_rows",
    f"""
    SELECT s.season, s.gp, date_text, url, sprint, scraped_at_utc, 'N' AS silver, 'N' AS bronze, race_id FROM staged s
    WHERE {_FLAG} = 'N' AND NOT EXISTS (FROM known k WHERE k.season = s.season AND k.gp = s.gp)
    QUALIFY row_number() OVER (
        PARTITION BY s.season, s.gp ORDER BY scraped_at_utc DESC NULLS LAST, date_text DESC NULLS LAST, url DESC NULLS LAST,
        sprint DESC NULLS LAST, race_id DESC NULLS LAST
    ) = 1
    """,
    staged=STAGED, known=KNOWN,
)
def new_rows(t: Tables):
    """The staged races to append to the master table."""
    return lookups.register_races(t(STAGED), t(KNOWN)).to_append


@query(
    "unprocessed",
    f"SELECT s.season, s.gp, race_id FROM staged s WHERE {_FLAG} = 'N'",
    staged=STAGED, known=KNOWN,
)
def unprocessed(t: Tables):
    return lookups.unprocessed(t(STAGED), t(KNOWN), ["season", "gp"], "bronze").select("season", "gp", "race_id")


@query(
    "promote_idempotent",
    """
    SELECT CAST(l_orderkey AS INTEGER) AS race_id, CAST(l_linenumber AS INTEGER) AS position, l_quantity AS points
    FROM lineitem
    """,
)
def promote_idempotent(t: Tables):
    """A base table after the same staging rows were promoted twice: each race once."""
    staging = t.lineitem.select(
        c("l_orderkey").cast("int").alias("race_id"), c("l_linenumber").alias("position"), c("l_quantity").alias("points")
    )
    finished = t.orders.filter(c("o_orderstatus") == "F").select(c("o_orderkey").cast("int").alias("race_id"))
    base = staging.join(finished, "race_id", "left_semi")
    once = base.unionByName(lookups.promote(staging, base, ["race_id"]))
    return once.unionByName(lookups.promote(staging, once, ["race_id"]))


@query(
    "run_log",
    """
    SELECT strftime(min(o_orderdate), '%Y-%m-%dT%H:%M:%S') AS "Datetime_Star",
           strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%S') AS "Datetime_end", 'loader' AS "User_Name", true AS "IsPipeline",
           CAST(count(*) AS VARCHAR) || ' rows' AS "Coment", 'load' AS "Action", 'orders' AS "NotebookName",
           CAST(year(o_orderdate) AS VARCHAR) AS "NotebookId", 'Races' AS "DestinationTable", CAST(NULL AS VARCHAR) AS "Target_path",
           CAST(NULL AS VARCHAR) AS "Src_Path"
    FROM orders GROUP BY year(o_orderdate)
    """,
)
def run_log(t: Tables):
    """One run-log row per season load: first and last stamp and the number of rows."""
    stamp = "yyyy-MM-dd'T'HH:mm:ss"
    loads = t.orders.groupBy(F.year("o_orderdate").cast("string").alias("NotebookId")).agg(
        F.date_format(F.min("o_orderdate"), stamp).alias("Datetime_Star"),
        F.date_format(F.max("o_orderdate"), stamp).alias("Datetime_end"),
        F.concat(F.count("*").cast("string"), F.lit(" rows")).alias("Coment"),
    )
    named = loads.withColumns(
        {
            "User_Name": F.lit("loader"), "IsPipeline": F.lit(True), "Action": F.lit("load"),
            "NotebookName": F.lit("orders"), "DestinationTable": F.lit("Races"),
        }
    )
    log = schemas.RUN_LOG.replace("timestamp not null", "string")
    return shape.conform(named, log)
