"""Page layouts: how each kind of session table is recognised and which columns it has."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from racelake import schemas


class Layout(NamedTuple):
    recognised: Callable[[Column], Column]
    """whether normalised headers belong to this kind of table"""
    headers: Mapping[str, tuple[str, ...]]
    """column name -> headers it may stand under, the first one present counts"""
    schema: str


def normal_headers(headers: Column) -> Column:
    """Headers as ``text.normal`` has them, all at once: read from a page they hold no line feeds, which keep them apart."""
    joined = F.regexp_replace(F.array_join(headers, "\n"), r"[\s\u00A0&&[^\n]]+", " ")
    return F.split(F.lower(F.trim(joined)), " ?\n ?", -1)


def _has(headers: Column, *names: str) -> Column:
    return reduce(and_, (F.array_contains(headers, n) for n in names))


def _has_one_of(headers: Column, *names: str) -> Column:
    return F.arrays_overlap(headers, F.array(*map(F.lit, names)))


def _part_of_one(headers: Column, *parts: str) -> Column:
    return F.exists(headers, lambda h: reduce(lambda a, b: a | b, (F.contains(h, F.lit(p)) for p in parts)))


def _is_result(h: Column) -> Column:
    return _has(h, "pos.", "no.", "driver", "team", "laps", "time / retired", "pts.")


def _is_qualifying(h: Column) -> Column:
    return _has(h, "driver") & _has_one_of(h, "q1", "q2", "q3")


def _is_grid(h: Column) -> Column:
    return _has(h, "driver") & _has_one_of(h, "pos.", "position", "grid") & ~_has_one_of(h, "q1", "q2", "q3")


def _is_fastest_laps(h: Column) -> Column:
    return _has(h, "driver", "lap") & _has_one_of(h, "time", "lap time")


def _is_pit_stops(h: Column) -> Column:
    timed = _has_one_of(h, "time") | _part_of_one(h, "time of day", "total")
    return F.exists(h, lambda x: F.startswith(x, F.lit("stop"))) & _part_of_one(h, "driver") & timed


def _is_practice(h: Column) -> Column:
    return _part_of_one(h, "driver") & _part_of_one(h, "laps") & _part_of_one(h, "time")


def _is_old_qualifying(h: Column) -> Column:
    return _has(h, "driver", "team") & _has_one_of(h, "pos.", "position") & _has_one_of(h, "time", "best time")


def is_season_index(h: Column) -> Column:
    return _has(h, "grand prix", "date")


def is_sprint_table(h: Column) -> Column:
    resultish = _has_one_of(h, "time / retired", "q1", "q2", "q3", "laps", "pts.", "grid")
    return _has_one_of(h, "pos.", "position") & _has(h, "driver") & resultish


# The headers under which result pages show each column.
_POSITION = ("pos.", "position")
_CAR = ("no.", "car no.")
_DRIVER = {"driver": ("driver",), "team": ("team",)}

_RESULT_HEADERS = {
    "position": ("pos.",), "car_number": ("no.",), **_DRIVER, "laps": ("laps",),
    "time_or_retired": ("time / retired",), "points": ("pts.",),
}
_QUALIFYING_HEADERS = {
    "position": ("pos.",), "car_number": ("no.",), **_DRIVER,
    "q1": ("q1",), "q2": ("q2",), "q3": ("q3",), "laps": ("laps",),
}
_GRID_HEADERS = {
    "grid_position": ("pos.", "position", "grid"), "car_number": ("no.",), **_DRIVER,
    "time_or_note": ("time / retired", "time"), "points": ("pts.",),
}
_FASTEST_LAP_HEADERS = {
    "position": _POSITION, "car_number": _CAR, **_DRIVER, "lap": ("lap",),
    "lap_time": ("time", "lap time"), "gap": ("gap",),
    "avg_speed_kph": ("avg speed", "average speed (km/h)", "speed", "km/h"),
    "points": ("pts.", "points"),
}
_PIT_STOP_HEADERS = {
    "stop": ("stop", "stops"), "car_number": _CAR, **_DRIVER, "lap": ("lap",),
    "time_of_day": ("time of day",), "pit_time": ("time",), "total_time": ("total", "total time"),
}
_PRACTICE_HEADERS = {
    "position": _POSITION, "car_number": _CAR, **_DRIVER, "time_or_gap": ("time / gap",),
    "time": ("time", "best time", "lap time"), "gap": ("gap",), "interval": ("interval",), "laps": ("laps",),
}
_OLD_QUALIFYING_HEADERS = {
    "position": _POSITION, "car_number": ("no.", "car no.", "number"), **_DRIVER,
    "time": ("time", "best time"), "laps": ("laps",), "points": ("pts.", "points"),
}

LAYOUTS = {
    "race-result": Layout(_is_result, _RESULT_HEADERS, schemas.RESULTS),
    "sprint-results": Layout(_is_result, _RESULT_HEADERS, schemas.SPRINT_RESULTS),
    "qualifying": Layout(_is_qualifying, _QUALIFYING_HEADERS, schemas.QUALIFYING),
    "sprint-qualifying": Layout(_is_qualifying, _QUALIFYING_HEADERS, schemas.QUALIFYING),
    "old-qualifying": Layout(_is_old_qualifying, _OLD_QUALIFYING_HEADERS, schemas.OLD_QUALIFYING),
    "starting-grid": Layout(_is_grid, _GRID_HEADERS, schemas.GRID),
    "sprint-grid": Layout(_is_grid, _GRID_HEADERS, schemas.GRID),
    "fastest-laps": Layout(_is_fastest_laps, _FASTEST_LAP_HEADERS, schemas.FAST_LAPS),
    "pit-stop-summary": Layout(_is_pit_stops, _PIT_STOP_HEADERS, schemas.PIT_STOPS),
    "practice": Layout(_is_practice, _PRACTICE_HEADERS, schemas.PRACTICE),
}
