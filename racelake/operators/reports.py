"""Aggregates behind the reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelake.functions import durations
from racelake.schemas import NUMERIC


def season_title(season: Column) -> Column:
    """Report heading: the latest season in sight."""
    return F.concat(F.max(season).cast("string"), F.lit(" RACE RESULTS"))


def total_laps(laps: Column) -> Column:
    return F.max(laps)


def total_time(secs: Column) -> Column:
    return F.sum(secs)


def total_clock(secs: Column) -> Column:
    """Total time as ``HH:MM:SS``."""
    return durations.clock(total_time(secs))


def season_choices(races: DataFrame, season: str) -> DataFrame:
    """The distinct seasons, latest first."""
    return races.select(season).distinct().orderBy(F.desc(season))


def has_any(condition: Column) -> Column:
    """Whether any row of a group meets the condition."""
    return F.coalesce(F.bool_or(condition), F.lit(False))


def grouped(rows: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Measures by group, as a report table shows them."""
    return rows.groupBy(*keys).agg(*(c.alias(name) for name, c in measures.items()))


def rollup_defaults(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every numeric column that is not a key summed up, the default of a report."""
    numeric = [n for n, kind in rows.dtypes if kind in NUMERIC and n not in keys]
    return rows.groupBy(*keys).agg(*(F.sum(n).alias(n) for n in numeric))
