"""Domain rules for positions, statuses and points."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from racelake.fixed import LATE_SCRATCH, NOT_FINISHED, RACE_POINTS, RACE_REPAIR, SPRINT_POINTS, SPRINT_REPAIR
from racelake.functions.text import strip


def raw_status(time_text: Column) -> Column:
    """Status told by the time cell: the reason for not finishing, or ``Finished``."""
    told = strip(time_text)
    return F.when(told.isin(*NOT_FINISHED), told).otherwise("Finished")


def race_position(position: Column, status: Column, time_text: Column) -> Column:
    """Position label: no position reads ``DQ`` for a finisher, else ``NC``.

    A finisher without time text, or marked as scratched, is not classified rather than
    disqualified (the comparison with a null text is not true).
    """
    return (
        F.when(position.isNotNull(), position.cast("string"))
        .when((status == "Finished") & (time_text != LATE_SCRATCH), "DQ")
        .otherwise("NC")
    )


def sprint_position(position: Column, status: Column) -> Column:
    return (
        F.when(position.isNotNull(), position.cast("string"))
        .when(status == "Finished", "DQ")
        .otherwise("NC")
    )


def classified_position(position: Column) -> Column:
    """Position label of a qualifying row."""
    return F.coalesce(position.cast("string"), F.lit("NC"))


def race_status(label: Column, status: Column, time_text: Column, laps: Column) -> Column:
    return (
        F.when(label == "DQ", "DSQ")
        .when((time_text == LATE_SCRATCH) & laps.isNull(), LATE_SCRATCH)
        .otherwise(status)
    )


def sprint_status(label: Column, status: Column) -> Column:
    return F.when(label == "DQ", "DSQ").otherwise(status)


def time_label(time_text: Column, status: Column, gap: Column) -> Column:
    """``OK`` reads as the gap of a finisher or the status of the others."""
    ok = time_text == "OK"
    return (
        F.when(ok & (status == "Finished"), gap.cast("string"))
        .when(ok & status.isNotNull(), status)
        .otherwise(time_text)
    )


def _points(table: tuple[int, ...], position: Column) -> Column:
    scale = F.array(*(F.lit(float(p)) for p in table))
    return F.coalesce(F.get(scale, position - 1), F.lit(0.0))


def race_points(position: Column) -> Column:
    return _points(RACE_POINTS, position)


def sprint_points(position: Column) -> Column:
    return _points(SPRINT_POINTS, position)


def _needs_repair(limits: tuple[int, int], points: Column, position: Column, season: Column) -> Column:
    last, since = limits
    return F.when((points == 0) & (position <= last) & (season >= since), "Y").otherwise("N")


def race_repair(points: Column, position: Column, season: Column) -> Column:
    """``Y`` where a scoring position of the current scale has no points."""
    return _needs_repair(RACE_REPAIR, points, position, season)


def sprint_repair(points: Column, position: Column, season: Column) -> Column:
    return _needs_repair(SPRINT_REPAIR, points, position, season)


def repaired(flag: Column, by_scale: Column, points: Column) -> Column:
    return F.when(flag == "Y", by_scale).otherwise(points)


def kept_flag(previous: Column) -> Column:
    """A processing flag that stays ``Y`` once set."""
    return F.when(previous == "Y", "Y").otherwise("N")


def current_season(year: Column, current: int) -> Column:
    return F.when(year == current, "Y").otherwise("N")
