"""Stored pages to bronze tables.

``parse`` reads every planned page once and is the only step that moves markup or runs Python;
write its result as a table and take all bronze tables and the error list from there. Everything
behind it works within a page (arrays, no shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelake import schemas
from racelake.functions import durations, links, rules, text
from racelake.operators.lookups import attach
from racelake.operators.reports import has_any
from racelake.operators.sessions import with_winner_gaps
from racelake.operators.shape import conform
from racelake.plans import weekend
from racelake.plans.layouts import LAYOUTS, is_season_index, is_sprint_table, normal_headers
from racelake.sources import html
from racelake.sources.pages import read_pages, read_stored
from racelake.sources.staging import staged

_STRICT = ("race-result", "sprint-results")  # kinds whose missing table is an error


def parse(plan: DataFrame, pages: DataFrame) -> DataFrame:
    """Planned session pages with their tables: one row per plan row, failures included."""
    return read_pages(plan, pages, {"event_title": html.title})


def parse_stored(plan: DataFrame, stored: DataFrame) -> DataFrame:
    """The same on a page store bucketed by URL."""
    return read_stored(plan, stored, {"event_title": html.title})


def _normal_tables() -> Column:
    """The tables of a page with their headers in normal form, made once for all tests of a table."""
    return F.transform("tables", lambda t: F.struct(normal_headers(t["headers"]).alias("headers"), t["rows"].alias("rows")))


def _first_table(recognised) -> Column:
    return F.get(F.filter(_normal_tables(), lambda t: recognised(t["headers"])), F.lit(0))


def _place(headers: Column, names: tuple[str, ...]) -> Column:
    """Place of the first of several headers that is present, null when none is."""
    places = (F.nullif(F.array_position(headers, n), F.lit(0)) for n in names)
    return F.coalesce(*places).cast("int")


def errors(parsed: DataFrame) -> DataFrame:
    """Pages that gave no rows for a reason worth knowing, as URL and error text."""
    missing = [
        F.when((F.col("kind") == k) & _first_table(LAYOUTS[k].recognised).isNull(), "no result table on the page")
        for k in _STRICT
    ]
    return parsed.select("page_url", F.coalesce("error", *missing).alias("error")).filter(F.col("error").isNotNull())


def rows_of(parsed: DataFrame, kind: str) -> DataFrame:
    """The bronze table of one kind of session."""
    layout = LAYOUTS[kind]
    page = parsed.filter(F.col("kind") == kind).withColumn("_table", _first_table(layout.recognised))
    headers = F.col("_table.headers")
    slug = links.parent_slug if kind == "race-result" else links.event_slug
    page = page.select(
        "season",
        "practice_no",
        F.col("page_url").alias("source_url"),
        "event_title",
        "scraped_at_utc",
        links.race_id(F.col("race_url")).alias("race_id"),
        slug(F.col("race_url")).alias("gp_slug"),
        F.struct(*(_place(headers, names).alias(c) for c, names in layout.headers.items())).alias("_place"),
        F.col("_table.rows.cells").alias("_rows"),
    )

    def cell(cells: Column, column: str) -> Column:
        return F.get(cells, F.col(f"_place.{column}") - 1)

    if kind in _STRICT:
        positions = F.transform("_rows", lambda cells: cell(cells, "position"))
        page = page.withColumn("_winner", F.array_position(positions, "1"))
    # pages without the table go after the explode: a filter ahead of it, an inner explode's own too, would look for the table again
    lines = page.select("*", F.posexplode_outer("_rows").alias("_line", "_cells")).filter(F.col("_line").isNotNull())
    lines = lines.withColumns({column: cell(F.col("_cells"), column) for column in layout.headers})
    return conform(_DERIVED[kind](lines.withColumns(_driver())), layout.schema)


def _driver() -> dict[str, Column]:
    return {
        "driver_name": text.driver_name(F.col("driver")),
        "driver_code": text.driver_code(F.col("driver")),
    }


def _results(lines: DataFrame) -> DataFrame:
    won = F.col("_line") + 1 == F.col("_winner")
    timed = with_winner_gaps(lines, won, F.col("_winner") > 0, "time_or_retired")
    return timed.withColumn("status", rules.raw_status(F.col("time_or_retired")))


def _seconds(**columns: str):
    return lambda lines: lines.withColumns({new: durations.seconds(F.col(c)) for new, c in columns.items()})


def _grid(lines: DataFrame) -> DataFrame:
    return lines


def _fastest_laps(lines: DataFrame) -> DataFrame:
    timed = _seconds(lap_time_s="lap_time", gap_s="gap")(lines)
    return timed.withColumn("avg_speed_kph", text.first_number(F.col("avg_speed_kph")))


def _practice(lines: DataFrame) -> DataFrame:
    combined, shared = F.col("time_or_gap"), F.col("_place.time_or_gap").isNotNull()
    split = lines.withColumns(
        {
            "time": F.when(shared, text.time_part(combined)).otherwise(F.col("time")),
            "gap": F.when(shared, text.gap_part(combined)).otherwise(F.col("gap")),
        }
    )
    return _seconds(time_s="time", gap_s="gap", interval_s="interval")(split)


_DERIVED = {
    "race-result": _results,
    "sprint-results": _results,
    "qualifying": _seconds(Q1_Segs="q1", Q2_Segs="q2", Q3_Segs="q3"),
    "sprint-qualifying": _seconds(Q1_Segs="q1", Q2_Segs="q2", Q3_Segs="q3"),
    "old-qualifying": _seconds(time_s="time"),
    "starting-grid": _grid,
    "sprint-grid": _grid,
    "fastest-laps": _fastest_laps,
    "pit-stop-summary": _seconds(pit_secs="pit_time", total_secs="total_time"),
    "practice": _practice,
}


# --- season index ---

# The addresses of a season's index page, a race's result page and its base page.
_INDEX = r"/en/results/(\d+)/races/?$"
_RESULT = r"/en/results/(\d+)/races/\d+/.+?/race-result/?$"
_BASE = r"/en/results/(\d+)/races/\d+/[^/]+/?$"


def _race_url(season: Column, targets: Column) -> Column:
    """The first result link of a row, else its first race link made one; ``targets`` are its absolute links."""

    def first(pattern: str) -> Column:
        return F.get(F.filter(targets, lambda u: F.regexp_extract(u, pattern, 1) == season), F.lit(0))

    return F.coalesce(first(_RESULT), F.concat(F.rtrim(first(_BASE), F.lit("/")), F.lit("/race-result")))


def season_races(pages: DataFrame) -> DataFrame:
    """The races listed on stored season index pages, sprint flag still open."""
    index = pages.filter(F.col("url").rlike(_INDEX))
    # an index is scraped again on every run: the newest copy counts
    newest = index.groupBy("url").agg(F.max(F.struct("scraped_at_utc", "page_id")).alias("_newest"))
    # a merge join, not a broadcast: how many indexes a store holds is not known beforehand
    index = index.join(newest.select("url", "_newest.page_id").hint("merge"), ["url", "page_id"])
    parsed = html.extract_tables(index, ["url", "scraped_at_utc"], with_links=True)
    listed = parsed.select("url", "scraped_at_utc", F.explode_outer(_first_table(is_season_index)["rows"]).alias("row"))
    listed = listed.filter(F.col("row").isNotNull())
    season = F.regexp_extract("url", _INDEX, 1)
    cells, row_links = F.col("row.cells"), F.col("row.links")
    listed = listed.withColumn("_targets", F.transform(F.flatten(row_links), lambda h: links.absolute(F.col("url"), h)))
    found = listed.select(
        season.cast("int").alias("season"),
        F.coalesce(F.get(cells, F.lit(0)), F.lit("")).alias("gp"),
        F.get(cells, F.lit(1)).alias("date_text"),
        _race_url(season, F.col("_targets")).alias("race_url"),
        F.col("scraped_at_utc"),
    )
    races = found.withColumnsRenamed({"race_url": "url"}).withColumns(
        {"race_id": links.race_id(F.col("url")), "silver": F.lit(""), "bronze": F.lit("")}
    )
    return conform(races, schemas.RACES)


def shows_sprint(no_results: Column) -> Column:
    """Whether a parsed page shows sprint results: a result table with at least one driver."""

    def filled(t: Column) -> Column:
        place = _place(t["headers"], ("driver",)) - 1
        return F.exists(t["rows"], lambda r: F.get(r["cells"], place).isNotNull())

    return ~no_results & F.exists(_normal_tables(), lambda t: is_sprint_table(t["headers"]) & filled(t))


def sprint_races(races: DataFrame, pages: DataFrame) -> DataFrame:
    """Race URLs that have a page among the sprint kinds, and whether any shows results.

    ``races`` is read once for the plan; give a table if it is costly.
    """
    # pages of other kinds are left out ahead of the look-up, which would move their markup
    pages = pages.filter(F.substring_index("url", "/", -1).isin(*weekend.SPRINT_KINDS))
    empty = {"no_results": lambda markup: text.mentions(markup, "no results available")}
    parsed = read_pages(weekend.sprint_plan(races), pages, empty, with_missing=False)
    return parsed.filter(F.col("error").isNull()).groupBy("race_url").agg(has_any(shows_sprint(F.col("no_results"))).alias("has_sprint"))


def list_races(pages: DataFrame) -> DataFrame:
    """The races table of all stored season index pages, sprints detected from their own pages.

    The index pages are parsed once: the races go to a table, from which the plan of sprint pages and the result are made.
    """
    races = staged(season_races(pages), "season-races")
    sprints = sprint_races(races, pages).withColumnRenamed("race_url", "url")
    flagged = attach(races, sprints, ["url"])
    sprint = F.when(F.coalesce("has_sprint", F.lit(False)), "Y").otherwise("N")
    return flagged.withColumn("sprint", sprint).select(*races.columns)
