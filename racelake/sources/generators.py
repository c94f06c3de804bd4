"""Rows made by rule: seasons and days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.fixed import CALENDAR_RANGE, SEASON_RANGE
from racelake.functions import rules


def seasons(spark: SparkSession, current: int, first: int = SEASON_RANGE[0], last: int = SEASON_RANGE[1]) -> DataFrame:
    """The season control table, latest first; only the current season is flagged."""
    years = spark.range(first, last + 1).select(F.col("id").cast("int").alias("year"))
    return years.withColumn("IsCurrentSeason", rules.current_season(F.col("year"), current)).orderBy(F.desc("year"))


def days(spark: SparkSession, first: str = CALENDAR_RANGE[0], last: str = CALENDAR_RANGE[1]) -> DataFrame:
    """One row per day, first and last day included."""
    count = (date.fromisoformat(last) - date.fromisoformat(first)).days + 1
    return spark.range(max(count, 0)).select(F.date_add(F.lit(first).cast("date"), F.col("id").cast("int")).alias("Date"))
