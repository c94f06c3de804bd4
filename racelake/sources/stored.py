"""Changes of stored tables that read and write only the partitions concerned.

A stored table is a table of the catalog, partitioned by a few columns (seasons, say). A change first finds the
partitions that hold a row concerned, reading nothing but the columns of the condition or key; only these
partitions are read in full and written again, and those that the change empties are dropped. All other
files stay as they are, unread.

New files are written beside the old ones and take their place when the whole job has succeeded: a change that
fails leaves the table as it was. To the driver come the values of partition columns alone, one row a partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from datetime import date
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from racelake.operators import changes
from racelake.operators.lookups import attach, having, promote
from racelake.operators.partitions import in_partitions, partition_values
from racelake.sources.staging import writing

_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


class Changed(NamedTuple):
    """What a change did to the partitions of a table."""

    rewritten: list[Row]
    dropped: list[Row]


def create(df: DataFrame, name: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    gathered(df, partition_by).write.format(fmt).partitionBy(*partition_by).saveAsTable(name)


def gathered(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of a partition in few files: gathered by it, and dealt to several tasks where it is large."""
    return df.hint("rebalance", *map(F.col, by)) if by else df


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def _literal(value: Any) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, date):
        return f"DATE '{value}'"
    return str(value) if isinstance(value, (int, float, bool)) else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def drop_partitions(spark: SparkSession, name: str, by: Sequence[str], values: Sequence[Row]) -> None:
    """Remove whole partitions, without reading a row."""
    if values:
        specs = (", ".join(f"`{c}` = {_literal(x)}" for c, x in zip(by, v)) for v in values)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(f"PARTITION ({s})" for s in specs))


@contextmanager
def _touched_partitions_only(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(_OVERWRITE_MODE)
    spark.conf.set(_OVERWRITE_MODE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(_OVERWRITE_MODE, before)


def rewrite(spark: SparkSession, name: str, concerned: DataFrame, change: Callable[[DataFrame], DataFrame]) -> Changed:
    """Change the partitions that ``concerned`` rows of the table (its partition columns) belong to."""
    by = partition_columns(spark, name)
    if not by:
        raise ValueError(f"{name} has no partitions")
    touched = partition_values(concerned, by)
    if not touched:
        return Changed([], [])
    columns = spark.table(name).columns
    changed = change(spark.table(name).filter(in_partitions(by, touched))).select(*columns)
    left = set(partition_values(changed, by))  # reads the columns that decide which rows stay
    if not left <= set(touched):
        raise ValueError("a change must not move rows to other partitions")
    if left:
        with _touched_partitions_only(spark):
            gathered(changed, by).write.mode("overwrite").insertInto(name)
    dropped = [v for v in touched if v not in left]
    drop_partitions(spark, name, by, dropped)
    return Changed([v for v in touched if v in left], dropped)


def update(spark: SparkSession, name: str, condition: Column | None, values: Mapping[str, Column]) -> Changed:
    """Set columns where a condition holds, or on all rows without one."""
    if set(values) & set(partition_columns(spark, name)):
        raise ValueError("a partition column cannot be updated in place")
    rows = spark.table(name)
    concerned = rows if condition is None else rows.filter(condition)
    return rewrite(spark, name, concerned, lambda df: changes.update_where(df, condition, values))


def confirm(spark: SparkSession, name: str, flag: str, races: DataFrame | None = None) -> Changed:
    """Mark races as ingested: all of them, or those listed by ``race_id``."""
    rows = spark.table(name)
    concerned = rows if races is None else having(rows, races, ["race_id"])
    return rewrite(spark, name, concerned, lambda df: changes.confirm(df, flag, races))


def delete(spark: SparkSession, name: str, condition: Column) -> Changed:
    """Delete the rows for which the condition is true."""
    return rewrite(spark, name, spark.table(name).filter(condition), lambda df: changes.delete_where(df, condition))


def delete_keys(spark: SparkSession, names: Sequence[str], doomed: DataFrame, keys: Sequence[str]) -> dict[str, Changed]:
    """Delete the rows of listed keys from several tables; rows without key stay."""
    return {
        name: rewrite(spark, name, having(spark.table(name), doomed, keys), lambda df: changes.delete_keys(df, doomed, keys))
        for name in names
    }


def truncate(spark: SparkSession, *names: str) -> None:
    """Delete all rows of some tables; their schemas stay."""
    for name in names:
        spark.sql(f"TRUNCATE TABLE {name}")


def correct(spark: SparkSession, name: str, corrections: DataFrame, keys: Sequence[str], column: str, delta: str) -> Changed:
    """Add keyed corrections to a numeric column, in the partitions that hold a corrected row."""
    concerned = having(spark.table(name), corrections, keys)
    return rewrite(spark, name, concerned, lambda df: changes.correct(df, corrections, keys, column, delta))


def repair(spark: SparkSession, name: str) -> Changed:
    """Mark finishers without laps and time as scratched."""
    return rewrite(spark, name, spark.table(name).filter(changes.lacks_time()), changes.mark_scratched)


def base_of(spark: SparkSession, name: str, incoming: DataFrame) -> DataFrame:
    """The partitions of a table that incoming rows belong to."""
    by = partition_columns(spark, name)
    rows = spark.table(name)
    return rows.filter(in_partitions(by, partition_values(incoming, by))) if by else rows


def promote_into(spark: SparkSession, name: str, incoming: DataFrame, keys: Sequence[str]) -> None:
    """Append the incoming rows whose key the table does not hold yet.

    A key belongs to one partition (a race to its season), so the table's keys are read in the partitions of
    the incoming rows only. ``incoming`` is read several times: give a stored table, or a cheap one. First the keys
    alone are compared: if all are new, or none is, as on a first run and its repetition, no row is moved for a join.
    """
    base = base_of(spark, name, incoming)
    held = base.select(*keys).distinct().withColumn("_held", F.lit(1))
    seen = attach(incoming.select(*keys).distinct(), held, keys, null_safe=True)
    known, all_keys = seen.agg(F.count("_held"), F.count(F.lit(1))).first()
    if known == all_keys:
        return
    fresh = promote(incoming, base, keys) if known else incoming
    with writing(spark):
        fresh.select(*spark.table(name).columns).write.insertInto(name)
