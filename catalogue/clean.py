"""Bronze-shaped rows cleaned to silver facts and dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import Tables, query
from racelake.plans import silver

c = F.col

# who drove, from where the row was read, and the notes in between
_BASE = """
    'Driver ' || l_partkey AS driver, CAST(l_suppkey AS INT) AS car_number, 'Team ' || l_returnflag AS team,
    CASE WHEN l_quantity > 45 THEN '* Car ' || l_suppkey || ' set back *' ELSE ' Driver' || chr(160) || l_partkey || ' ' END AS driver_name,
    CASE WHEN l_linestatus = 'F' THEN upper(substr('abcdefgh', l_linenumber, 3)) END AS driver_code,
    'https://results.example.org/races/' || l_orderkey AS source_url, 'Event ' || l_suppkey AS event_title,
    '2024-01-01T00:00:00' AS scraped_at_utc, CAST(l_orderkey AS INT) AS race_id, 'gp-' || l_suppkey AS gp_slug,
    CAST(2005 + l_orderkey % 20 AS INT) AS season
"""
_OUT = """
    trim(replace(driver_name, chr(160), ' ')) AS "Driver_Name", driver_code AS "Driver_Code", source_url AS "Source_Url",
    event_title AS "Event_Title", scraped_at_utc AS "Scraped_Timestamp", race_id AS "Race_Id", gp_slug AS "Gp_Slug",
    season AS "Season"
"""

RESULTS = f"""
SELECT {_BASE},
       CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN NULL
            ELSE CAST(1 + (l_linenumber * 3 + l_suppkey) % 14 AS INT) END AS position,
       CASE WHEN l_quantity < 6 THEN NULL ELSE CAST(l_quantity AS INT) END AS laps,
       CASE CAST(l_linenumber AS INT) WHEN 1 THEN 'OK' WHEN 2 THEN 'SHC' WHEN 3 THEN NULL WHEN 4 THEN 'DNF'
            WHEN 5 THEN '+1 lap' WHEN 6 THEN 'OK' ELSE '1:30:12.5' END AS time_or_retired,
       CASE CAST(l_linenumber AS INT) WHEN 4 THEN 'DNF' WHEN 6 THEN 'DNS' ELSE 'Finished' END AS status,
       CASE WHEN l_linenumber = 7 THEN 5412.5 END AS race_time_s, CAST(l_suppkey AS DOUBLE) + 0.25 AS gap_to_winner_s,
       CASE WHEN l_quantity > 45 THEN NULL WHEN l_discount < 0.05 THEN 0.0 ELSE CAST(floor(l_tax * 100) AS DOUBLE) END AS points
FROM {{lineitem}}
"""


def _results_sql(label: str, status: str, flag: str, scale: str) -> str:
    return f"""
    SELECT label AS "Position", car_number AS "Car_Number", team AS "Team", laps AS "Laps",
           CASE WHEN time_or_retired = 'OK' AND clean_status <> 'Finished' THEN clean_status
                WHEN time_or_retired = 'OK' THEN CAST(gap_to_winner_s AS VARCHAR) ELSE time_or_retired END AS "Time_Or_Retired",
           CAST(CASE WHEN fix = 'Y' THEN {scale} ELSE points END AS DOUBLE) AS "Points", clean_status AS "Status",
           CAST(race_time_s AS DOUBLE) AS "Race_Time_S", gap_to_winner_s AS "Gap_To_Winner_S", fix AS "Fix_Points", {_OUT}
    FROM (SELECT *, {status} AS clean_status, CASE WHEN {flag} THEN 'Y' ELSE 'N' END AS fix
          FROM (SELECT *, CASE WHEN position IS NOT NULL THEN CAST(position AS VARCHAR) WHEN {label} THEN 'DQ' ELSE 'NC' END AS label
                FROM src WHERE points IS NOT NULL))
    """


@query(
    "clean_results",
    _results_sql(
        "status = 'Finished' AND time_or_retired <> 'SHC'",
        "CASE WHEN label = 'DQ' THEN 'DSQ' WHEN time_or_retired = 'SHC' AND laps IS NULL THEN 'SHC' ELSE status END",
        "points = 0 AND position <= 10 AND season >= 2010",
        "coalesce([25, 18, 15, 12, 10, 8, 6, 4, 2, 1][position], 0)",
    ),
    src=RESULTS,
)
def clean_results(t: Tables):
    return silver.clean_results(t(RESULTS))


@query(
    "clean_sprint",
    _results_sql(
        "status = 'Finished'",
        "CASE WHEN label = 'DQ' THEN 'DSQ' ELSE status END",
        "points = 0 AND position <= 8 AND season >= 2022",
        "coalesce([8, 7, 6, 5, 4, 3, 2, 1][position], 0)",
    ),
    src=RESULTS,
)
def clean_sprint(t: Tables):
    return silver.clean_sprint_results(t(RESULTS))


QUALIFYING = f"""
SELECT {_BASE}, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END AS position,
       '1:2' || l_linenumber || '.5' AS q1, CASE WHEN l_linenumber < 5 THEN '1:2' || l_linenumber || '.25' END AS q2,
       CASE WHEN l_linenumber < 3 THEN 'no time' END AS q3,
       CASE WHEN l_quantity > 45 THEN NULL ELSE CAST(l_quantity AS INT) END AS laps,
       80.5 + l_linenumber AS Q1_Segs, CASE WHEN l_linenumber < 5 THEN 80.25 + l_linenumber END AS Q2_Segs,
       CASE WHEN l_linenumber < 3 THEN l_extendedprice / 7000 END AS Q3_Segs
FROM {{lineitem}}
"""


_QUALIFYING_SQL = f"""
    SELECT coalesce(CAST(position AS VARCHAR), 'NC') AS "Position", car_number AS "Car_number", team AS "Team", q1 AS "Q1", q2 AS "Q2",
           q3 AS "Q3", laps AS "Laps", CAST(round(coalesce("Q1_Segs", 0), 3) AS DOUBLE) AS "Q1_Segs",
           CAST(round(coalesce("Q2_Segs", 0), 3) AS DOUBLE) AS "Q2_Segs", CAST(round(coalesce("Q3_Segs", 0), 3) AS DOUBLE) AS "Q3_Segs", {_OUT}
    FROM src WHERE laps IS NOT NULL
    """


@query("clean_qualifying", _QUALIFYING_SQL, src=QUALIFYING)
def clean_qualifying(t: Tables):
    return silver.clean_qualifying(t(QUALIFYING))


SPRINT_QUALIFYING = QUALIFYING.replace("l_linenumber < 5", "l_linenumber < 4").replace("'1:2'", "'1:1'")


@query("clean_sprint_qualifying", _QUALIFYING_SQL, src=SPRINT_QUALIFYING)
def clean_sprint_qualifying(t: Tables):
    """Sprint qualifying: the same rules under another session's footnotes."""
    return silver.clean_qualifying(t(SPRINT_QUALIFYING), "sprint_qualifying")


OLD_QUALIFYING = f"""
SELECT {_BASE.replace("CAST(l_suppkey AS INT) AS car_number", "CASE WHEN l_quantity > 45 THEN NULL ELSE CAST(l_suppkey AS INT) END AS car_number")}, CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber END AS position, '1:2' || l_linenumber || '.5' AS time,
       CAST(80.5 + l_linenumber AS DOUBLE) AS time_s, CASE WHEN l_quantity < 20 THEN NULL ELSE CAST(l_quantity AS INT) END AS laps,
       CAST(NULL AS INT) AS points
FROM {{lineitem}}
"""


@query(
    "clean_old_qualifying",
    f"""
    SELECT coalesce(CAST(position AS VARCHAR), 'NC') AS "Position", car_number AS "Car_Number", team AS "Team", time AS "Time",
           time_s AS "Time_Segs", coalesce(laps, 0) AS "Laps", points AS "Points", {_OUT}
    FROM src WHERE car_number IS NOT NULL
    """,
    src=OLD_QUALIFYING,
)
def clean_old_qualifying(t: Tables):
    return silver.clean_old_qualifying(t(OLD_QUALIFYING))


PRACTICE = f"""
SELECT {_BASE}, 1 + CAST(l_suppkey % 3 AS INT) AS practice_no, CASE WHEN l_linenumber = 6 THEN NULL ELSE l_linenumber END AS position,
       '1:2' || l_linenumber || '.5' AS time, CASE WHEN l_quantity > 20 THEN CAST(80.5 + l_quantity AS DOUBLE) END AS time_s,
       '+' || l_linenumber || '.125' AS gap, CASE WHEN l_linenumber <> 1 THEN CAST(l_linenumber + 0.125 AS DOUBLE) END AS gap_s,
       '+0.1' AS "interval", CAST(0.1 AS DOUBLE) AS interval_s, CASE WHEN l_quantity > 45 THEN NULL ELSE CAST(l_quantity AS INT) END AS laps
FROM {{lineitem}}
"""


@query(
    "clean_practice",
    f"""
    SELECT position AS "Position", car_number AS "Car_number", driver AS "Driver", team AS "Team", time AS "Time", time_s AS "Time_s",
           gap AS "Gap", gap_s AS "Gap_s", base AS "Base_time_s", round(base + coalesce(gap_s, 0), 3) AS "Real_time_s", laps AS "Laps",
           practice_no AS "Practice_No", 'Practice ' || practice_no AS "Practice", {_OUT}
    FROM (SELECT *, first_value(time_s) OVER (PARTITION BY race_id, practice_no
              ORDER BY (time_s IS NULL), (position IS NULL), position, time_s
              ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS base
          FROM src WHERE laps IS NOT NULL)
    """,
    src=PRACTICE,
)
def clean_practice(t: Tables):
    return silver.clean_practices(t(PRACTICE.replace('"interval"', "`interval`")))


GRID = f"""
SELECT {_BASE}, CASE WHEN l_quantity > 45 THEN NULL ELSE l_linenumber END AS grid_position,
       '1:2' || l_linenumber || '.5' AS time_or_note, CAST(NULL AS INT) AS points
FROM {{lineitem}}
"""


_GRID_SQL = f"""
    SELECT grid_position AS "Grid_Position", car_number AS "Car_Number", team AS "Team", time_or_note AS "Time", {_OUT}
    FROM src WHERE grid_position IS NOT NULL
    """


@query("clean_grid", _GRID_SQL, src=GRID)
def clean_grid(t: Tables):
    return silver.clean_grid(t(GRID))


SPRINT_GRID = GRID.replace("ELSE l_linenumber END AS grid_position", "ELSE 8 - l_linenumber END AS grid_position")


@query("clean_sprint_grid", _GRID_SQL, src=SPRINT_GRID)
def clean_sprint_grid(t: Tables):
    return silver.clean_grid(t(SPRINT_GRID), "sprint_grid")


LAPS = f"""
SELECT {_BASE}, l_linenumber AS position, CAST(l_quantity AS INT) AS lap, '1:2' || l_linenumber || '.5' AS lap_time,
       CASE WHEN l_quantity > 45 THEN NULL ELSE l_extendedprice / 7000 END AS lap_time_s
FROM {{lineitem}}
"""


@query(
    "clean_laps",
    f"""
    SELECT position AS "Position", car_number AS "Car_Number", team AS "Team", lap AS "Lap", lap_time AS "Lap_Time",
           round(lap_time_s, 3) AS "Lap_Time_S", {_OUT}
    FROM src WHERE lap_time_s IS NOT NULL
    """,
    src=LAPS,
)
def clean_laps(t: Tables):
    return silver.clean_fast_laps(t(LAPS))


PITS = f"""
SELECT {_BASE}, CASE WHEN l_quantity > 45 THEN NULL ELSE l_linenumber END AS stop, CAST(l_quantity AS INT) AS lap,
       '14:0' || l_linenumber || ':00' AS time_of_day, '2' || l_linenumber || '.5' AS pit_time, CAST(20.5 + l_linenumber AS DOUBLE) AS pit_secs,
       '1:0' || l_linenumber || '.5' AS total_time, CAST(60.5 + l_linenumber AS DOUBLE) AS total_secs
FROM {{lineitem}}
"""


@query(
    "clean_pits",
    f"""
    SELECT stop AS "Stops", car_number AS "Car_Number", team AS "Team", lap AS "Lap", time_of_day AS "Time_Of_Day", pit_time AS "Pit_Time",
           pit_secs AS "Pit_Secs", total_time AS "Total_Time", total_secs AS "Total_Secs", {_OUT}
    FROM src WHERE stop IS NOT NULL
    """,
    src=PITS,
)
def clean_pits(t: Tables):
    return silver.clean_pit_stops(t(PITS))


_NOTES = " UNION ALL ".join(
    f"""SELECT trim(replace(driver_name, '*', '')) AS "Note", race_id AS "Race_Id", season AS "Season", gp_slug AS "Gp_Slug", '{event}' AS "Event"
        FROM {source} WHERE {marker} IS NULL"""
    for event, source, marker in (
        ("Race", "results", "points"), ("Sprint Race", "results", "points"), ("Qualifying", "qualifying", "laps"),
        ("Sprint_Qualifying", "qualifying", "laps"), ("Old Qualifying", "old_qualifying", "car_number"), ("Practices", "practice", "laps"),
        ("Starting Grid", "grid", "grid_position"), ("Sprint Starting Grid", "grid", "grid_position"),
    )
)


@query("race_notes", _NOTES, results=RESULTS, qualifying=QUALIFYING, old_qualifying=OLD_QUALIFYING, practice=PRACTICE, grid=GRID)
def race_notes(t: Tables):
    """The footnotes of all eight sessions in one table."""
    results, qualifying, grid = t(RESULTS), t(QUALIFYING), t(GRID)
    return silver.race_notes(
        {
            "race": results, "sprint": results, "qualifying": qualifying, "sprint_qualifying": qualifying,
            "old_qualifying": t(OLD_QUALIFYING), "practice": t(PRACTICE.replace('"interval"', "`interval`")), "grid": grid, "sprint_grid": grid,
        }
    )


# the date of an order as a race date text: a day, or a range of days
RACES = """
SELECT CAST(year(o_orderdate) AS INT) AS season, 'gp-' || o_custkey AS gp, 'Y' AS sprint, CAST(o_orderkey AS INT) AS race_id,
       CASE CAST(o_orderkey % 6 AS INT)
           WHEN 0 THEN lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || ' ' || month_en
           WHEN 1 THEN CAST(day(o_orderdate) AS STRING) || ' - 31 ' || upper(month_en)
           WHEN 2 THEN ' ' || CAST(day(o_orderdate) AS STRING) || ' ' || lower(month_es) || ' '
           WHEN 3 THEN '31 ' || month_en
           WHEN 4 THEN 'abc'
           ELSE NULL END AS date_text
FROM (SELECT *, substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(month(o_orderdate) * 3 - 2 AS INT), 3) AS month_en,
             substr('EneFebMarAbrMayJunJulAgoSepOctNovDic', CAST(month(o_orderdate) * 3 - 2 AS INT), 3) AS month_es FROM {orders}) AS o
"""


@query(
    "races_dim",
    """
    SELECT season, gp, sprint, race_id, date_text, month AS "Month", id_month AS "Id_Month", id_day AS "Id_Day",
           strftime(TRY_CAST(printf('%04d-%02d-%02d', season, id_month, id_day) AS DATE), '%Y-%m-%d') AS "Date", 'N' AS "Gold"
    FROM (SELECT *, upper(right(trim(date_text), 3)) AS month, CAST(no AS INTEGER) AS id_month,
                 TRY_CAST(nullif(regexp_extract(trim(date_text), '^([0-9]{1,2})', 1), '') AS INTEGER) AS id_day
          FROM src LEFT JOIN (VALUES ('JAN', 1), ('FEB', 2), ('MAR', 3), ('APR', 4), ('MAY', 5), ('JUN', 6), ('JUL', 7), ('AUG', 8),
              ('SEP', 9), ('OCT', 10), ('NOV', 11), ('DEC', 12), ('ENE', 1), ('ABR', 4), ('AGO', 8), ('DIC', 12)) AS m(abbr, no)
            ON abbr = upper(right(trim(date_text), 3)))
    """,
    src=RACES,
)
def races_dim(t: Tables):
    return silver.races_dimension(t(RACES)).withColumn("Date", c("Date").cast("string"))


COUNTRIES = """
SELECT n_name AS country, n_nationkey AS country_id, 'https://img.example.org/' || n_name || '.png?web=1&e=' || c_custkey AS image, c_custkey
FROM {customer} JOIN {nation} ON n_nationkey = c_nationkey
"""


@query(
    "dim_country",
    """SELECT country, country_id, image AS "Sharepoint_Image_URL", c_custkey,
              regexp_replace(image, '[?].*', '?download=1') AS "URL_Download" FROM src""",
    src=COUNTRIES,
)
def dim_country(t: Tables):
    return silver.country_dimension(t(COUNTRIES).withColumnRenamed("image", "Sharepoint_Image_URL"))


@query(
    "dim_drivers",
    """
    SELECT s_name AS "Driver_Name", CAST(s_nationkey AS VARCHAR) AS "Nationality", CAST(2000 + s_suppkey % 25 AS INTEGER) AS "LastSeason",
           CASE WHEN s_acctbal > 0 THEN 1990 END AS "FirstSeason",
           CASE WHEN s_nationkey > 3 THEN '19' || lpad(CAST(60 + s_suppkey % 40 AS VARCHAR), 2, '0') || '-02-28' END AS "DOB"
    FROM supplier
    """,
)
def dim_drivers(t: Tables):
    drivers = t(
        """
        SELECT s_name AS driver_name_clean, s_nationkey AS Nationality, CAST(2000 + s_suppkey % 25 AS STRING) AS LastSeason,
               CASE WHEN s_acctbal > 0 THEN '1990' ELSE 'unknown' END AS FirstSeason, s_acctbal,
               '19' || (60 + s_suppkey % 40) || CASE WHEN s_nationkey > 3 THEN '-02-28' ELSE '-02-30' END AS DOB
        FROM {supplier}
        """
    )
    return silver.drivers_dimension(drivers).withColumn("DOB", c("DOB").cast("string"))


@query(
    "dim_tracks",
    """SELECT p_partkey AS "Track_Key", p_name AS "Track_Name", p_brand AS "Country", p_size AS "Year_Built" FROM part""",
)
def dim_tracks(t: Tables):
    tracks = t.part.selectExpr("p_partkey AS TrackKey", "p_name AS TrackName", "p_brand AS Country", "p_size AS YearBuilt", "p_type")
    return silver.tracks_dimension(tracks)
