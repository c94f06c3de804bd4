"""Row changes: update, delete, correct and repair, as new versions of a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelake.fixed import LATE_SCRATCH
from racelake.operators.lookups import attach, lacking


def update_where(df: DataFrame, condition: Column | None, changes: Mapping[str, Column]) -> DataFrame:
    """Set columns where the condition is true, or on all rows without one.

    The new values are computed from the old row and take the column's type.
    """
    hit = F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))
    kinds = dict(df.dtypes)
    changed = {
        name: F.when(hit, value.cast(kinds[name])).otherwise(F.col(name)) for name, value in changes.items()
    }
    return df.select(*(changed[c].alias(c) if c in changed else F.col(c) for c in df.columns))


def confirm(df: DataFrame, flag: str, races: DataFrame | None = None) -> DataFrame:
    """Mark races as ingested: all of them, or those listed by ``race_id``."""
    if races is None:
        return update_where(df, None, {flag: F.lit("Y")})
    seen = races.groupBy("race_id").agg(F.lit("Y").alias("_seen"))
    marked = attach(df, seen, ["race_id"])
    return update_where(marked, F.col("_seen") == "Y", {flag: F.lit("Y")}).drop("_seen")


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """The rows for which the condition is not true."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def delete_keys(df: DataFrame, doomed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key is not listed; rows without key stay."""
    return lacking(df, doomed, keys)


def delete_keys_everywhere(
    tables: Mapping[str, DataFrame], doomed: DataFrame, keys: Sequence[str]
) -> dict[str, DataFrame]:
    """The same keys deleted from several tables."""
    return {name: delete_keys(df, doomed, keys) for name, df in tables.items()}


def emptied(df: DataFrame) -> DataFrame:
    """The table without its rows."""
    return df.filter(F.lit(False))


def correct(df: DataFrame, corrections: DataFrame, keys: Sequence[str], column: str, delta: str) -> DataFrame:
    """Add keyed corrections to a numeric column; several corrections of one key add up."""
    sums = corrections.groupBy(*keys).agg(F.sum(delta).alias("_delta"))
    found = attach(df, sums, keys)
    kind = dict(df.dtypes)[column]
    fixed = (F.col(column) + F.coalesce(F.col("_delta"), F.lit(0))).cast(kind)
    return found.withColumn(column, fixed).select(*df.columns)


def lacks_time() -> Column:
    """A finisher without laps and time."""
    return (F.col("status") == "Finished") & F.col("laps").isNull() & F.col("time_or_retired").isNull()


def mark_scratched(results: DataFrame) -> DataFrame:
    """Results in which a finisher without laps and time is marked as scratched."""
    return update_where(results, lacks_time(), {"time_or_retired": F.lit(LATE_SCRATCH)})


def season_sample(df: DataFrame, seasons: Sequence[int]) -> DataFrame:
    """The rows of a few whole seasons, for a trial lake."""
    return df.filter(F.col("season").isin(*seasons))
