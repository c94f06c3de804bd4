"""Star joins, aggregates and the season report."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import Tables, query
from catalogue.functions import CARS
from racelake.operators import reports, sessions
from racelake.operators.lookups import star
from racelake.plans import gold

c = F.col

# orders as the results of races, customers as the races, nations as the countries
RESULTS = """
SELECT o_custkey AS Race_Id, CASE o_orderpriority WHEN '1-URGENT' THEN '1' WHEN '2-HIGH' THEN '2' ELSE 'NC' END AS Position,
       CASE o_orderstatus WHEN 'F' THEN 'Finished' ELSE 'DNF' END AS Status,
       'Driver ' || CAST(o_custkey % 40 AS STRING) AS Driver_Name, o_orderstatus AS Team,
       CAST(floor(o_totalprice / 10000) AS INT) AS Laps, CAST(o_orderkey AS STRING) AS Time_Or_Retired
FROM {orders}
"""
RACES = """
SELECT c_custkey AS Race_Id, 'NATION_' || CAST(c_nationkey AS STRING) AS Country, c_name AS Gp,
       CAST(2000 + c_custkey % 25 AS INT) AS Season, CAST(floor(c_acctbal) AS INT) AS offset_days
FROM {customer}
"""
COUNTRIES = """
SELECT n_name AS Country, 'https://img.example.org/' || n_name || '.png' AS URL_Download
FROM {nation} WHERE n_regionkey <> 4
"""


def _races(t: Tables):
    day = F.date_add(F.make_date("Season", F.lit(1), F.lit(1)), F.pmod("offset_days", F.lit(365)).cast("int"))
    return t(RACES).withColumn("Date", day)


@query(
    "season_report",
    """
    SELECT "URL_Download", "Gp", strftime(day, '%Y-%m-%d') AS "Date", strftime(day, '%d %b') AS "DATE_LABEL",
           "Driver_Name", "Team", "Time_Or_Retired", CAST(max("Laps") AS INTEGER) AS "Laps"
    FROM (SELECT *, CAST(make_date("Season", 1, 1) + CAST(((offset_days % 365) + 365) % 365 AS INTEGER) AS DATE) AS day
          FROM races WHERE "Season" IN (2024, 2023))
    JOIN results USING ("Race_Id") LEFT JOIN countries USING ("Country")
    WHERE "Position" IN ('1') AND "Status" IN ('Finished')
    GROUP BY ALL ORDER BY "Date", "Gp", "Driver_Name", "Team", "Time_Or_Retired"
    """,
    results=RESULTS, races=RACES, countries=COUNTRIES,
)
def season_report(t: Tables):
    """Winners of two seasons by date, with flag, laps and time."""
    listed = gold.season_winners(t(RESULTS), _races(t), t(COUNTRIES), [2024, 2023])
    return listed.withColumn("Date", c("Date").cast("string"))


@query(
    "season_report_numbered",
    """
    SELECT *, row_number() OVER (ORDER BY "Date" NULLS FIRST, "Gp" NULLS FIRST, "Driver_Name" NULLS FIRST, "Team" NULLS FIRST,
        "Time_Or_Retired" NULLS FIRST, "Laps" NULLS FIRST, "URL_Download" NULLS FIRST) AS "Line_No"
    FROM (
    SELECT "URL_Download", "Gp", strftime(day, '%Y-%m-%d') AS "Date", strftime(day, '%d %b') AS "DATE_LABEL",
           "Driver_Name", "Team", "Time_Or_Retired", CAST(max("Laps") AS INTEGER) AS "Laps"
    FROM (SELECT *, CAST(make_date("Season", 1, 1) + CAST(((offset_days % 365) + 365) % 365 AS INTEGER) AS DATE) AS day
          FROM races WHERE "Season" IN (2024, 2023))
    JOIN results USING ("Race_Id") LEFT JOIN countries USING ("Country")
    WHERE "Position" IN ('1') AND "Status" IN ('Finished')
    GROUP BY ALL)
    """,
    results=RESULTS, races=RACES, countries=COUNTRIES,
)
def season_report_numbered(t: Tables):
    """The same report with the number of every line, so that its order is compared."""
    listed = gold.numbered_winners(t(RESULTS), _races(t), t(COUNTRIES), [2024, 2023])
    return listed.withColumn("Date", c("Date").cast("string"))


@query(
    "star_join",
    """
    SELECT o_orderkey, c_name, n_name, r_name FROM orders
    LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey
    """,
)
def star_join(t: Tables):
    fact = t.orders.select("o_orderkey", c("o_custkey").alias("c_custkey"))
    wide = star(
        fact,
        (t.customer.select("c_custkey", "c_name", c("c_nationkey").alias("n_nationkey")), "c_custkey"),
        (t.nation.withColumnRenamed("n_regionkey", "r_regionkey"), "n_nationkey"),
        (t.region, "r_regionkey"),
    )
    return wide.select("o_orderkey", "c_name", "n_name", "r_name")


@query(
    "races_with_tracks",
    """
    SELECT o_orderkey AS "Race_Id", o_custkey AS "Track_Key", p_brand AS "Country"
    FROM orders LEFT JOIN part ON p_partkey = o_custkey
    """,
)
def races_with_tracks(t: Tables):
    """Races with the country of their track."""
    races = t.orders.select(c("o_orderkey").alias("Race_Id"), c("o_custkey").alias("Track_Key"))
    tracks = t.part.select(c("p_partkey").alias("Track_Key"), c("p_name").alias("Track_Name"), c("p_brand").alias("Country"))
    return gold.races_with_tracks(races, tracks)


@query("report_title", "SELECT CAST(max(year(o_orderdate)) AS VARCHAR) || ' RACE RESULTS' AS title FROM orders")
def report_title(t: Tables):
    return t.orders.agg(reports.season_title(F.year("o_orderdate")).alias("title"))


@query(
    "season_slicer",
    "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS season FROM orders ORDER BY season DESC",
)
def season_slicer(t: Tables):
    return reports.season_choices(t.orders.select(F.year("o_orderdate").alias("season")), "season")


@query(
    "total_time_hms",
    """
    SELECT l_orderkey, CAST(max(l_linenumber) AS INTEGER) AS laps, total AS secs,
           lpad(CAST(total // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST(total // 60 % 60 AS VARCHAR), 2, '0') || ':'
               || lpad(CAST(total % 60 AS VARCHAR), 2, '0') AS total_time
    FROM (SELECT l_orderkey, l_linenumber, CAST(sum(l_quantity * 97) OVER (PARTITION BY l_orderkey) AS BIGINT) AS total
          FROM lineitem)
    GROUP BY l_orderkey, total
    """,
)
def total_time_hms(t: Tables):
    secs = c("l_quantity") * 97
    measures = {
        "laps": reports.total_laps(c("l_linenumber")),
        "secs": reports.total_time(secs).cast("long"),
        "total_time": reports.total_clock(secs),
    }
    return reports.grouped(t.lineitem, ["l_orderkey"], measures)


@query(
    "default_rollup",
    """
    SELECT l_returnflag, l_linestatus, CAST(sum(l_orderkey) AS BIGINT) AS l_orderkey, CAST(sum(l_partkey) AS BIGINT) AS l_partkey,
           CAST(sum(l_suppkey) AS BIGINT) AS l_suppkey, CAST(sum(l_linenumber) AS BIGINT) AS l_linenumber,
           sum(l_quantity) AS l_quantity, round(sum(l_extendedprice), 2) AS l_extendedprice,
           round(sum(l_discount), 2) AS l_discount, round(sum(l_tax), 2) AS l_tax
    FROM lineitem GROUP BY ALL
    """,
)
def default_rollup(t: Tables):
    totals = reports.rollup_defaults(t.lineitem, ["l_returnflag", "l_linestatus"])
    # sums of fractions differ in the last digit
    return totals.withColumns({name: F.round(name, 2) for name in ("l_extendedprice", "l_discount", "l_tax")})


@query(
    "any_in_group",
    """
    SELECT l_suppkey, coalesce(bool_or(position = 1 AND status = 'Finished'), false) AS has_won,
           coalesce(bool_or(time_or_retired = 'DNF'), false) AS has_retired
    FROM src GROUP BY l_suppkey
    """,
    src=CARS,
)
def any_in_group(t: Tables):
    """Whether a car ever won or retired."""
    measures = {
        "has_won": reports.has_any((c("position") == 1) & (c("status") == "Finished")),
        "has_retired": reports.has_any(c("time_or_retired") == "DNF"),
    }
    return reports.grouped(t(CARS), ["l_suppkey"], measures)


# events as practice rows: a user's events of one kind are a session
PRACTICE = """
SELECT event_id, user_id AS race_id, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS practice_no,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(event_id % 50 AS INT) END AS position, CAST(event_id AS INT) AS car_number,
       CASE WHEN value > 40 THEN CAST(floor(value) AS DOUBLE) + 0.125 END AS time_s,
       CASE WHEN event_id % 3 = 0 THEN CAST(floor(value) AS DOUBLE) / 8 END AS gap_s
FROM {events}
"""


@query(
    "leader_time",
    """
    SELECT event_id, base_time_s, round(base_time_s + coalesce(gap_s, 0), 3) AS real_time_s,
           round(base_time_s + gap_s, 3) AS strict_time_s
    FROM (SELECT *, first_value(time_s) OVER (PARTITION BY race_id, practice_no
              ORDER BY (time_s IS NULL), (position IS NULL), position, time_s
              ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS base_time_s FROM src)
    """,
    src=PRACTICE,
)
def leader_time(t: Tables):
    """Leader's time of every session on its rows, and each row's own time."""
    timed = sessions.leader_times(t(PRACTICE))
    strict = F.round(c("base_time_s") + c("gap_s"), 3)
    return timed.select("event_id", "base_time_s", "real_time_s", strict.alias("strict_time_s"))


# line items as the cars of a race (their order), in a total order
RACE_ROWS = """
SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey * 10 + l_linenumber AS line,
       CASE WHEN l_quantity > 40 THEN NULL ELSE l_linenumber END AS position,
       CASE WHEN l_linenumber = 1 THEN '1:' || lpad(CAST(CAST(l_quantity AS INT) AS STRING), 2, '0') || '.5'
            WHEN l_linenumber < 5 THEN '+' || CAST(l_suppkey AS STRING) || '.25s'
            WHEN l_linenumber = 5 THEN '+1 lap' ELSE 'DNF' END AS time_or_retired
FROM {lineitem}
"""


@query(
    "winner_gap",
    """
    SELECT l_orderkey, l_partkey, l_linenumber,
           CASE WHEN line = winner AND time_or_retired LIKE '1:%' THEN 60 + CAST(substr(time_or_retired, 3) AS DOUBLE) END AS race_time_s,
           CASE WHEN line <> winner AND time_or_retired LIKE '+%s'
                THEN CAST(replace(replace(time_or_retired, '+', ''), 's', '') AS DOUBLE) END AS gap_to_winner_s
    FROM (SELECT *, min(line) FILTER (position = 1) OVER (PARTITION BY l_orderkey) AS winner FROM src)
    """,
    src=RACE_ROWS,
)
def winner_gap(t: Tables):
    """Race time of the winner and gaps of the others, only in races that have a winner."""
    timed = sessions.winner_gaps(t(RACE_ROWS), ["l_orderkey"], "position", "time_or_retired", "line")
    return timed.select("l_orderkey", "l_partkey", "l_linenumber", "race_time_s", "gap_to_winner_s")
