"""Which session pages a race has, by season and sprint flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelake.fixed import MODERN_QUALIFYING_SINCE, PIT_STOPS_SINCE, SPRINT_QUALIFYING_SINCE, SPRINTS_SINCE
from racelake.functions import links

SPRINT_KINDS = ("sprint-results", "sprint-qualifying", "sprint-grid")


def worklist(races: DataFrame, season: int, flag: str = "bronze") -> DataFrame:
    """Races of a season that are not processed yet."""
    return races.filter((F.col("season") == season) & (F.col(flag) == "N"))


def is_sprint(sprint: Column) -> Column:
    return F.upper(sprint).isin("Y", "S")


def has_full_practice(sprint: Column) -> Column:
    return F.upper(sprint) == "N"


def current_seasons(seasons: DataFrame) -> DataFrame:
    return seasons.filter(F.col("IsCurrentSeason") == "Y")


def _session(kind: str, path: str | None = None, number: int | None = None) -> Column:
    return F.struct(
        F.lit(kind).alias("kind"), F.lit(path or kind).alias("path"), F.lit(number).cast("int").alias("practice_no")
    )


def sessions(season: Column, sprint: Column) -> Column:
    """The applicable session pages of a race as an array of kind, path and practice number."""
    modern = season >= MODERN_QUALIFYING_SINCE
    applicable = [
        (F.lit(True), _session("race-result")),
        (F.lit(True), _session("starting-grid")),
        (F.lit(True), _session("fastest-laps")),
        (season >= PIT_STOPS_SINCE, _session("pit-stop-summary")),
        (season < MODERN_QUALIFYING_SINCE, _session("old-qualifying", "qualifying/0")),
        (modern, _session("qualifying")),
        (modern, _session("practice", "practice/1", 1)),
        (modern & has_full_practice(sprint), _session("practice", "practice/2", 2)),
        (modern & has_full_practice(sprint), _session("practice", "practice/3", 3)),
        (is_sprint(sprint) & (season >= SPRINT_QUALIFYING_SINCE), _session("sprint-qualifying")),
        (is_sprint(sprint) & (season >= SPRINTS_SINCE), _session("sprint-grid")),
        (is_sprint(sprint) & (season >= SPRINTS_SINCE), _session("sprint-results")),
    ]
    return F.array_compact(F.array(*(F.when(condition, session) for condition, session in applicable)))


def session_plan(races: DataFrame) -> DataFrame:
    """One row per race and session page; races without URL have none."""
    planned = races.filter(F.col("url").isNotNull()).select(
        "season", F.col("url").alias("race_url"), links.session_base(F.col("url")).alias("base"),
        F.explode(sessions(F.col("season"), F.col("sprint"))).alias("s"),
    )
    url = links.session_of(F.col("race_url"), F.col("base"), F.col("s.path"))
    return planned.select("season", "race_url", "s.kind", "s.practice_no", url.alias("page_url"))


def sprint_plan(races: DataFrame) -> DataFrame:
    """The pages that would exist if every race had a sprint."""
    kind = F.explode(F.array(*map(F.lit, SPRINT_KINDS))).alias("kind")
    asked = races.filter(F.col("url").isNotNull()).select(F.col("url").alias("race_url")).distinct()
    asked = asked.withColumn("_base", links.session_base(F.col("race_url"))).select("race_url", "_base", kind)
    return asked.select("race_url", "kind", links.session_of(F.col("race_url"), F.col("_base"), F.col("kind")).alias("page_url"))
