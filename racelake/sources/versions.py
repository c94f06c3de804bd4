"""Versions of a table, kept as partitions of one stored table.

The version is the first partition column, before the table's own ones, so a reader of one version lists and
reads its files only. A version counts once it stands in the table's properties, together with its number of rows
(counted while they were written) and the time of writing; a write that failed does not count, its number is
not used again. Format and partitioning are those of the table; a version may be derived from older ones.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from racelake.operators.partitions import partition_values
from racelake.operators.snapshots import VERSION, at_version
from racelake.sources import stored

_PROPERTY = "racelake.version."


def log(spark: SparkSession, name: str) -> dict[int, dict]:
    """The complete versions with their ``rows`` and ``written_at``, from the catalog alone."""
    if not spark.catalog.tableExists(name):
        return {}
    properties = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    found = {int(p["key"].removeprefix(_PROPERTY)): json.loads(p["value"]) for p in properties if p["key"].startswith(_PROPERTY)}
    return dict(sorted(found.items()))


def versions(spark: SparkSession, name: str) -> list[int]:
    return list(log(spark, name))


def history(spark: SparkSession, name: str) -> DataFrame:
    """(_version, row_count, written_at) of the complete versions, without reading a row of them."""
    rows = [(n, entry["rows"], entry["written_at"]) for n, entry in log(spark, name).items()]
    return spark.createDataFrame(rows, f"{VERSION} int, row_count bigint, written_at string")


def _next(spark: SparkSession, name: str) -> int:
    listed = (p[0].split("/")[0].split("=")[1] for p in spark.sql(f"SHOW PARTITIONS {name}").collect())
    return max([*log(spark, name), *map(int, listed)], default=-1) + 1


def write(df: DataFrame, name: str, partition_by: Sequence[str] = (), fmt: str = "parquet", written_at: str | None = None) -> int:
    """Write a table as its next version; ``partition_by`` and ``fmt`` hold from the first one on."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        empty = df.filter(F.lit(False)).withColumn(VERSION, F.lit(0))
        stored.create(empty, name, [VERSION, *partition_by], fmt)
    version, counted = _next(spark, name), Observation()
    rows = df.observe(counted, F.count(F.lit(1)).alias("rows")).withColumn(VERSION, F.lit(version))
    rows.select(*spark.table(name).columns).write.insertInto(name)
    entry = {"rows": counted.get["rows"], "written_at": written_at or datetime.now(timezone.utc).isoformat(timespec="seconds")}
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_PROPERTY}{version}' = '{json.dumps(entry)}')")
    return version


def read(spark: SparkSession, name: str, version: int | None = None) -> DataFrame:
    """A version of a table, the latest complete one by default."""
    known = versions(spark, name)
    wanted = version if version is not None else (known[-1] if known else None)
    if wanted not in known:
        raise ValueError(f"{name} has no complete version {wanted}")
    return at_version(spark.table(name), wanted)


def read_all(spark: SparkSession, name: str) -> DataFrame:
    """All complete versions, under their version column."""
    return spark.table(name).filter(F.col(VERSION).isin(*versions(spark, name)))


def restore(spark: SparkSession, name: str, version: int, written_at: str | None = None) -> int:
    """Make an old version the current one; the versions in between are kept."""
    return write(read(spark, name, version), name, written_at=written_at)


def expire(spark: SparkSession, name: str, keep: int) -> list[int]:
    """Drop all but the latest ``keep`` complete versions, and what failed writes left before them."""
    if keep < 1:
        raise ValueError("the current version is kept")
    known = versions(spark, name)
    if len(known) <= keep:
        return []
    first = known[-keep]
    old = [n for n in known if n < first]
    # a version that does not count any more cannot be read half dropped
    spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS (" + ", ".join(f"'{_PROPERTY}{n}'" for n in old) + ")")
    by = stored.partition_columns(spark, name)
    values = partition_values(spark.table(name).filter(F.col(VERSION) < first), by)
    stored.drop_partitions(spark, name, by, values)
    return old
