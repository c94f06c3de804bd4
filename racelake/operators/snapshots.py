"""Snapshots of a table kept side by side under a version column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VERSION = "_version"


def at_version(snapshots: DataFrame, version: int) -> DataFrame:
    """The table as of a version; on a table partitioned by version only that partition is read."""
    return snapshots.filter(F.col(VERSION) == version).drop(VERSION)


def history(snapshots: DataFrame, written_at: str) -> DataFrame:
    """Versions with their row count and time of writing."""
    return snapshots.groupBy(VERSION).agg(
        F.count("*").alias("row_count"), F.max(written_at).alias("written_at")
    )


def restored(snapshots: DataFrame, version: int, as_version: int) -> DataFrame:
    """The snapshots plus an old version once more as the newest one."""
    again = at_version(snapshots, version).withColumn(VERSION, F.lit(as_version).cast("int"))
    return snapshots.unionByName(again)
