"""Calendar, point corrections and the season report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelake.functions import dates
from racelake.operators.changes import correct
from racelake.operators.lookups import star
from racelake.operators.order import with_position
from racelake.operators.reports import grouped, total_laps


def calendar_columns(day: str = "Date") -> dict[str, Column]:
    """The attributes of a calendar day."""
    d = F.col(day)
    return {
        "Id_Month": F.month(d),
        "Month": dates.month_name(d),
        "Mth": dates.month_short(d),
        "Year": F.year(d),
        "Id_Quarter": F.quarter(d),
        "Id_Day": dates.iso_weekday(d),
        "Day_Name": dates.day_name(d),
        "Day_Name_Short": dates.day_short(d),
        "MonthWeek": dates.week_of_month(d),
        "YearWeek": F.weekofyear(d),
        "Date_StarOfMonth": dates.month_start(d),
        "Date_EndOfMonth": F.last_day(d),
        "Date_StarOfWeek": dates.week_start(d),
        "Date_EndOfWeek": dates.week_end(d),
        "IdPeriod": dates.period_key(d),
    }


def calendar(days: DataFrame, day: str = "Date") -> DataFrame:
    """A table of days with its calendar attributes, the day itself as ``Date``."""
    dated = days.withColumnRenamed(day, "Date")
    return dated.select("Date", *(c.alias(name) for name, c in calendar_columns().items()))


def correct_points(results: DataFrame, corrections: DataFrame) -> DataFrame:
    """Results with ``Delta`` points added by race and position label."""
    return correct(results, corrections, ["Race_Id", "Position"], "Points", "Delta")


def races_with_tracks(races: DataFrame, tracks: DataFrame) -> DataFrame:
    """The races dimension as reports see it: each race with the country of its track."""
    return star(races, (tracks.select("Track_Key", "Country"), "Track_Key"))


REPORT_ORDER = ("Date", "Gp", "Driver_Name", "Team", "Time_Or_Retired")


def season_winners(
    results: DataFrame, races: DataFrame, countries: DataFrame, seasons: Sequence[int],
    positions: Sequence[str] = ("1",), statuses: Sequence[str] = ("Finished",),
) -> DataFrame:
    """The winners of the chosen seasons by date, as the season page lists them."""
    return _winners(results, races, countries, seasons, positions, statuses).orderBy(*REPORT_ORDER)


def numbered_winners(
    results: DataFrame, races: DataFrame, countries: DataFrame, seasons: Sequence[int],
    positions: Sequence[str] = ("1",), statuses: Sequence[str] = ("Finished",),
) -> DataFrame:
    """The same list with every line's number, ``Line_No``; ties go by laps and flag."""
    listed = _winners(results, races, countries, seasons, positions, statuses)
    return with_position(listed, [*REPORT_ORDER, "Laps", "URL_Download"], "Line_No")


def _winners(results, races, countries, seasons, positions, statuses) -> DataFrame:
    chosen = results.filter(F.col("Position").isin(*positions) & F.col("Status").isin(*statuses))
    chosen = chosen.select("Race_Id", "Driver_Name", "Team", "Laps", "Time_Or_Retired")
    held = races.filter(F.col("Season").isin(*seasons)).select("Race_Id", "Country", "Gp", "Date")
    flags = countries.select("Country", "URL_Download")
    wide = star(chosen.join(held, "Race_Id"), (flags, "Country"))
    keys = ["URL_Download", "Gp", "Date", "Driver_Name", "Team", "Time_Or_Retired"]
    listed = grouped(wide, keys, {"Laps": total_laps(F.col("Laps"))})
    day = dates.report_day(F.col("Date")).alias("DATE_LABEL")
    return listed.select("*", day)
