"""Scalar rules: text, links, durations, dates, points."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.base import Tables, query
from racelake.functions import dates, durations, links, rules, text
from racelake.sources import html
from racelake.sources.generators import days, seasons
from racelake.plans import weekend
from racelake.plans.gold import calendar, calendar_columns

c = F.col

# every spelling of a duration, and texts that are none
CLOCKS = """
SELECT o_orderkey, CAST(o_orderkey % 14 AS INT) AS form, CASE CAST(o_orderkey % 14 AS INT)
    WHEN 0 THEN m || ':' || s || '.' || f
    WHEN 1 THEN h || ':' || lpad(m, 2, '0') || ':' || s || '.' || f
    WHEN 2 THEN '+' || s || '.' || f || 's'
    WHEN 3 THEN '+' || m || ':' || s || '.' || f
    WHEN 4 THEN s || '.' || f
    WHEN 5 THEN '+1 lap'
    WHEN 6 THEN 'DNF'
    WHEN 7 THEN ''
    WHEN 8 THEN '-'
    WHEN 9 THEN '—'
    WHEN 10 THEN 'no time'
    WHEN 11 THEN ' ' || m || ':' || s || chr(160)
    WHEN 12 THEN h || ':' || m || ':' || s || ':' || s
    ELSE NULL END AS cell
FROM (SELECT o_orderkey, CAST(ms % 1000 + 1000 AS STRING) AS f1, substr(CAST(ms % 1000 + 1000 AS STRING), 2, 3) AS f,
             lpad(CAST(CAST(floor(ms / 1000) AS BIGINT) % 60 AS STRING), 2, '0') AS s,
             CAST(CAST(floor(ms / 60000) AS BIGINT) % 60 AS STRING) AS m,
             CAST(CAST(floor(ms / 3600000) AS BIGINT) AS STRING) AS h
      FROM (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS ms FROM {orders}) AS priced) AS parts
"""

_SECONDS = """
    CASE WHEN regexp_full_match(body, '([0-9]+:){0,2}[0-9]+([.][0-9]+)?') THEN round(
        CASE len(string_split(body, ':'))
            WHEN 3 THEN CAST(split_part(body, ':', 1) AS DOUBLE) * 3600 + CAST(split_part(body, ':', 2) AS DOUBLE) * 60
                        + CAST(split_part(body, ':', 3) AS DOUBLE)
            WHEN 2 THEN CAST(split_part(body, ':', 1) AS DOUBLE) * 60 + CAST(split_part(body, ':', 2) AS DOUBLE)
            ELSE CAST(body AS DOUBLE) END, 3) END
"""


@query(
    "duration_seconds",
    f"""
    SELECT o_orderkey, form, {_SECONDS} AS secs,
           CASE WHEN trim(cell, ' ' || chr(160)) NOT IN ('', '-', '—', 'no time') THEN cell END AS known,
           CASE WHEN starts_with(cell, '+') THEN cell END AS gap,
           CASE WHEN NOT starts_with(cell, '+') THEN cell END AS lap
    FROM (SELECT *, regexp_replace(regexp_replace(trim(cell, ' ' || chr(160)), '^[+]+', ''), 's+$', '') AS body FROM src)
    """,
    src=CLOCKS,
)
def duration_seconds(t: Tables):
    cell = c("cell")
    return t(CLOCKS).select(
        "o_orderkey", "form",
        durations.to_millis(durations.seconds(cell)).alias("secs"),
        text.known_text(cell, "no time").alias("known"),
        text.gap_part(cell).alias("gap"),
        text.time_part(cell).alias("lap"),
    )


# names with and without code, joined by nothing, a space or a no-break space
DRIVERS = """
SELECT c_custkey, CASE CAST(c_custkey % 5 AS INT)
    WHEN 0 THEN replace(c_name, '#', ' ') || upper(substr(c_mktsegment, 1, 3))
    WHEN 1 THEN replace(c_name, '#', chr(160)) || chr(160) || upper(substr(c_mktsegment, 1, 3))
    WHEN 2 THEN chr(160) || replace(c_name, '#', ' ') || ' ' || upper(substr(c_mktsegment, 1, 3)) || ' '
    WHEN 3 THEN c_name
    ELSE upper(substr(c_mktsegment, 1, 3)) END AS driver
FROM {customer}
"""


@query(
    "driver_code",
    """
    SELECT c_custkey,
           replace(CASE WHEN name <> '' THEN name ELSE whole END, chr(160), ' ') AS driver_name,
           nullif(code, '') AS driver_code
    FROM (SELECT c_custkey, whole, regexp_extract(whole, '([A-Z]{3})$', 1) AS code,
                 CASE WHEN regexp_matches(whole, '[A-Z]{3}$')
                      THEN trim(left(whole, length(whole) - 3), ' ' || chr(160)) ELSE '' END AS name
          FROM (SELECT c_custkey, trim(driver, ' ' || chr(160)) AS whole FROM src))
    """,
    src=DRIVERS,
)
def driver_code(t: Tables):
    return t(DRIVERS).select(
        "c_custkey",
        text.plain_spaces(text.driver_name(c("driver"))).alias("driver_name"),
        text.driver_code(c("driver")).alias("driver_code"),
    )


# links on every stored page, and the race addresses built from its number
RACE_URLS = """
SELECT page_id, url, CASE CAST(page_id % 4 AS INT)
    WHEN 0 THEN 'https://results.example.org/en/results/2021/races/' || page_id || '/gp-' || (page_id % 7) || '/race-result'
    WHEN 1 THEN 'https://results.example.org/en/results/2021/races/' || page_id
    WHEN 2 THEN 'https://results.example.org/en/drivers/' || page_id || '/'
    ELSE '' END AS race_url,
    CASE CAST(page_id % 6 AS INT)
    WHEN 0 THEN 'https://other.example.org/a' WHEN 1 THEN '//cdn.example.org/b' WHEN 2 THEN '/c/d'
    WHEN 3 THEN 'e/f' WHEN 4 THEN '?page=2' ELSE '#top' END AS href
FROM {pages}
"""


@query(
    "url_keys",
    r"""
    SELECT page_id, TRY_CAST(nullif(regexp_extract(race_url, '/races/([0-9]+)(/|$)', 1), '') AS INTEGER) AS race_id,
           nullif(regexp_extract(race_url, '/races/[0-9]+/([^/]+)/', 1), '') AS slug,
           CASE WHEN len(parts) >= 2 THEN parts[len(parts) - 1] END AS parent,
           CASE WHEN race_url <> '' THEN regexp_replace(race_url, '/[^/]*$', '') || '/fastest-laps' END AS session_url,
           CASE WHEN race_url <> '' THEN regexp_replace(race_url, '/[^/]*$', '') || '/practice/2' END AS practice_url,
           CASE WHEN href LIKE 'https:%' THEN href
                WHEN href LIKE '//%' THEN regexp_extract(url, '^[^:]*:') || href
                WHEN href LIKE '/%' THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || href
                WHEN href LIKE '?%' THEN regexp_replace(url, '[?#].*$', '') || href
                WHEN href LIKE '#%' THEN regexp_replace(url, '#.*$', '') || href
                ELSE regexp_replace(regexp_replace(url, '[?#].*$', ''), '/[^/]*$', '/') || href END AS target,
           regexp_replace(url, '[?].*', '?download=1') AS download
    FROM (SELECT *, string_split(rtrim(race_url, '/'), '/') AS parts FROM src)
    """,
    src=RACE_URLS,
)
def url_keys(t: Tables):
    race = c("race_url")
    return t(RACE_URLS).select(
        "page_id",
        links.race_id(race).alias("race_id"),
        links.event_slug(race).alias("slug"),
        links.parent_slug(race).alias("parent"),
        links.session_url(race, "fastest-laps").alias("session_url"),
        links.practice_url(race, 2).alias("practice_url"),
        links.absolute(c("url"), c("href")).alias("target"),
        links.download_link(c("url")).alias("download"),
    )


# measures hidden in text
MEASURES = """
SELECT p_partkey, CASE CAST(p_partkey % 5 AS INT)
    WHEN 0 THEN p_name || ' ' || CAST(p_size AS STRING) || ',' || CAST(p_partkey % 90 + 10 AS STRING) || ' km/h'
    WHEN 1 THEN '-' || CAST(p_size AS STRING) || '.5 of ' || p_type
    WHEN 2 THEN p_name
    WHEN 3 THEN '+' || CAST(p_size AS STRING)
    ELSE NULL END AS measure,
    CASE WHEN p_partkey % 3 = 0 THEN 'Sorry, NO Results Available for ' || p_name ELSE p_name END AS body
FROM {part}
"""


@query(
    "number_in_text",
    """
    SELECT p_partkey, TRY_CAST(nullif(regexp_extract(replace(measure, ',', '.'), '[-+]?[0-9]+([.][0-9]+)?'), '') AS DOUBLE)
               AS first_number,
           contains(lower(body), 'no results available') AS without_results
    FROM src
    """,
    src=MEASURES,
)
def number_in_text(t: Tables):
    return t(MEASURES).select(
        "p_partkey",
        text.first_number(c("measure")).alias("first_number"),
        text.mentions(c("body"), "No results available").alias("without_results"),
    )


# a line item as a classified (or not classified) car
CARS = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       CAST(2005 + l_orderkey % 20 AS INT) AS season,
       CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN NULL
            ELSE CAST(1 + (l_linenumber * 3 + l_suppkey) % 14 AS INT) END AS position,
       CASE WHEN l_quantity < 6 THEN NULL ELSE CAST(l_quantity AS INT) END AS laps,
       CASE CAST(l_linenumber AS INT) WHEN 1 THEN 'OK' WHEN 2 THEN 'SHC' WHEN 3 THEN NULL WHEN 4 THEN 'DNF'
            WHEN 5 THEN '+1 lap' WHEN 6 THEN 'OK' ELSE '1:30:12.5' END AS time_or_retired,
       CASE CAST(l_linenumber AS INT) WHEN 4 THEN 'DNF' WHEN 6 THEN 'DNS' ELSE 'Finished' END AS status,
       CAST(l_suppkey AS DOUBLE) + 0.25 AS gap_to_winner_s,
       CASE WHEN l_discount < 0.05 THEN 0.0 ELSE floor(l_tax * 100) END AS points
FROM {lineitem}
"""

_LABEL = """CASE WHEN position IS NOT NULL THEN CAST(position AS VARCHAR)
    WHEN status = 'Finished' AND time_or_retired <> 'SHC' THEN 'DQ' ELSE 'NC' END"""
_SPRINT_LABEL = """CASE WHEN position IS NOT NULL THEN CAST(position AS VARCHAR)
    WHEN status = 'Finished' THEN 'DQ' ELSE 'NC' END"""


@query(
    "position_label",
    f"""
    SELECT l_orderkey, l_partkey, l_linenumber, {_LABEL} AS race, {_SPRINT_LABEL} AS sprint,
           coalesce(CAST(position AS VARCHAR), 'NC') AS qualifying
    FROM src
    """,
    src=CARS,
)
def position_label(t: Tables):
    return t(CARS).select(
        "l_orderkey", "l_partkey", "l_linenumber",
        rules.race_position(c("position"), c("status"), c("time_or_retired")).alias("race"),
        rules.sprint_position(c("position"), c("status")).alias("sprint"),
        rules.classified_position(c("position")).alias("qualifying"),
    )


_STATUS = """CASE WHEN label = 'DQ' THEN 'DSQ' WHEN time_or_retired = 'SHC' AND laps IS NULL THEN 'SHC' ELSE status END"""
_TIME = """CASE WHEN time_or_retired = 'OK' AND clean_status <> 'Finished' THEN clean_status
    WHEN time_or_retired = 'OK' AND clean_status = 'Finished' THEN CAST(gap_to_winner_s AS VARCHAR)
    ELSE time_or_retired END"""


@query(
    "status_label",
    f"""
    SELECT l_orderkey, l_partkey, l_linenumber, {_STATUS} AS race,
           CASE WHEN sprint_label = 'DQ' THEN 'DSQ' ELSE status END AS sprint,
           CASE WHEN trim(time_or_retired) IN ('DNF', 'DNS', 'DSQ') THEN trim(time_or_retired) ELSE 'Finished' END AS raw
    FROM (SELECT *, {_LABEL} AS label, {_SPRINT_LABEL} AS sprint_label FROM src)
    """,
    src=CARS,
)
def status_label(t: Tables):
    label = rules.race_position(c("position"), c("status"), c("time_or_retired"))
    sprint = rules.sprint_position(c("position"), c("status"))
    return t(CARS).select(
        "l_orderkey", "l_partkey", "l_linenumber",
        rules.race_status(label, c("status"), c("time_or_retired"), c("laps")).alias("race"),
        rules.sprint_status(sprint, c("status")).alias("sprint"),
        rules.raw_status(c("time_or_retired")).alias("raw"),
    )


@query(
    "time_label",
    f"""
    SELECT l_orderkey, l_partkey, l_linenumber, {_TIME} AS time_text
    FROM (SELECT *, {_STATUS} AS clean_status FROM (SELECT *, {_LABEL} AS label FROM src))
    """,
    src=CARS,
)
def time_label(t: Tables):
    label = rules.race_position(c("position"), c("status"), c("time_or_retired"))
    status = rules.race_status(label, c("status"), c("time_or_retired"), c("laps"))
    return t(CARS).select(
        "l_orderkey", "l_partkey", "l_linenumber",
        rules.time_label(c("time_or_retired"), status, c("gap_to_winner_s")).alias("time_text"),
    )


_RACE_SCALE = "coalesce([25, 18, 15, 12, 10, 8, 6, 4, 2, 1][position], 0)"
_SPRINT_SCALE = "coalesce([8, 7, 6, 5, 4, 3, 2, 1][position], 0)"


@query(
    "points_repair",
    f"""
    SELECT l_orderkey, l_partkey, l_linenumber, race_flag, sprint_flag,
           CAST(CASE WHEN race_flag = 'Y' THEN {_RACE_SCALE} ELSE points END AS DOUBLE) AS race_points,
           CAST(CASE WHEN sprint_flag = 'Y' THEN {_SPRINT_SCALE} ELSE points END AS DOUBLE) AS sprint_points
    FROM (SELECT *, CASE WHEN points = 0 AND position <= 10 AND season >= 2010 THEN 'Y' ELSE 'N' END AS race_flag,
                 CASE WHEN points = 0 AND position <= 8 AND season >= 2022 THEN 'Y' ELSE 'N' END AS sprint_flag FROM src)
    """,
    src=CARS,
)
def points_repair(t: Tables):
    race = rules.race_repair(c("points"), c("position"), c("season"))
    sprint = rules.sprint_repair(c("points"), c("position"), c("season"))
    points = c("points").cast("double")
    return t(CARS).select(
        "l_orderkey", "l_partkey", "l_linenumber", race.alias("race_flag"), sprint.alias("sprint_flag"),
        rules.repaired(race, rules.race_points(c("position")), points).alias("race_points"),
        rules.repaired(sprint, rules.sprint_points(c("position")), points).alias("sprint_points"),
    )


def _texts(*columns: str) -> dict:
    """Dates as ISO text, which both engines show alike."""
    return {d: c(d).cast("string") for d in columns}


_CALENDAR_DATES = ("Date", "Date_StarOfMonth", "Date_EndOfMonth", "Date_StarOfWeek", "Date_EndOfWeek")
_CALENDAR_SQL = """
    strftime(d, '%Y-%m-%d') AS "Date", CAST(month(d) AS INTEGER) AS "Id_Month", monthname(d) AS "Month",
    left(monthname(d), 3) AS "Mth", CAST(year(d) AS INTEGER) AS "Year", CAST(quarter(d) AS INTEGER) AS "Id_Quarter",
    CAST(isodow(d) AS INTEGER) AS "Id_Day", dayname(d) AS "Day_Name", left(dayname(d), 3) AS "Day_Name_Short",
    CAST((day(d) + isodow(date_trunc('month', d)) - 2) // 7 + 1 AS INTEGER) AS "MonthWeek",
    CAST(weekofyear(d) AS INTEGER) AS "YearWeek",
    strftime(date_trunc('month', d), '%Y-%m-%d') AS "Date_StarOfMonth",
    strftime(last_day(d), '%Y-%m-%d') AS "Date_EndOfMonth",
    strftime(date_trunc('week', d), '%Y-%m-%d') AS "Date_StarOfWeek",
    strftime(date_trunc('week', d) + INTERVAL 6 DAY, '%Y-%m-%d') AS "Date_EndOfWeek",
    CAST(year(d) * 1000 + month(d) AS INTEGER) AS "IdPeriod"
"""


@query(
    "calendar",
    f"""
    SELECT {_CALENDAR_SQL}, coalesce(n, 0) AS orders
    FROM (SELECT CAST(unnest(generate_series(DATE '1950-01-01', DATE '2050-12-31', INTERVAL 1 DAY)) AS DATE) AS d)
    LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1) ON day = d
    """,
)
def master_calendar(t: Tables):
    """The whole master calendar with the number of orders of each day."""
    placed = t.orders.groupBy(F.to_date("o_orderdate").alias("Date")).agg(F.count("*").alias("orders"))
    joined = calendar(days(t.spark)).join(placed, "Date", "left")
    return joined.withColumns(_texts(*_CALENDAR_DATES) | {"orders": F.coalesce("orders", F.lit(0))})


@query(
    "calendar_of_events",
    f"""SELECT {_CALENDAR_SQL}, event_id FROM (SELECT event_id, CAST(ts AS DATE) AS d FROM events)""",
)
def calendar_of_events(t: Tables):
    """Calendar attributes computed on the rows themselves, without a join."""
    dated = t.events.select("event_id", F.to_date("ts").alias("Date"))
    return dated.withColumns(calendar_columns()).withColumns(_texts(*_CALENDAR_DATES))


@query(
    "seasons",
    """
    SELECT CAST(y AS INTEGER) AS year, CASE WHEN y = 2001 THEN 'Y' ELSE 'N' END AS "IsCurrentSeason", coalesce(n, 0) AS races
    FROM (SELECT unnest(generate_series(1950, 2025)) AS y)
    LEFT JOIN (SELECT year(o_orderdate) AS held, count(*) AS n FROM orders GROUP BY 1) ON held = y
    ORDER BY year DESC
    """,
)
def season_control(t: Tables):
    """The season control table with the races (orders) of each season."""
    held = t.orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("races"))
    joined = seasons(t.spark, current=2001).join(held, "year", "left")
    return joined.withColumn("races", F.coalesce("races", F.lit(0))).orderBy(F.desc("year"))


@query(
    "current_season_races",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) = 2001",
)
def current_season_races(t: Tables):
    """Races of the seasons flagged as current."""
    current = weekend.current_seasons(seasons(t.spark, current=2001)).select("year")
    return t.orders.select("o_orderkey", F.year("o_orderdate").alias("year")).join(current, "year", "left_semi").select(
        "o_orderkey", "year"
    )


@query("scrape_stamp", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS scraped_at_utc FROM events")
def scrape_stamp(t: Tables):
    return t.events.select("event_id", dates.iso_stamp(c("ts")).alias("scraped_at_utc"))


@query(
    "page_titles",
    """
    SELECT page_id, nullif(trim(regexp_replace(replace(replace(replace(replace(regexp_replace(
        regexp_extract(regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script>|<style\\b.*?</style>', '', 'g'),
                       '(?is)<h[12]\\b[^>]*>(.*?)</h[12]>', 1),
        '<[^>]*>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\\s+', ' ', 'g')), '') AS title
    FROM pages
    """,
)
def page_titles(t: Tables):
    return t.pages.select("page_id", html.title(c("html")).alias("title"))


@query(
    "page_links",
    """
    SELECT page_id, CAST(link_no AS INTEGER) AS link_no, word AS text, href,
           CASE WHEN href LIKE 'http%' THEN href ELSE regexp_extract(url, '^[a-z]+://[^/?#]*') || href END AS target
    FROM (SELECT page_id, url, unnest(hrefs) AS href, unnest(texts) AS word, generate_subscripts(hrefs, 1) AS link_no
          FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1) AS hrefs,
                       regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2) AS texts FROM pages))
    """,
)
def page_links(t: Tables):
    return html.page_links(t.pages, ["page_id"])
