"""Reading and writing tables.

The format is a parameter: Parquet by default, and any installed source (a transaction-log format
among them) by its name. Plain Parquet cannot replace the files it is reading, so tables that are
derived from themselves are written as a new version (``versions``) or changed partition by partition
(``stored``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from racelake.operators.lookups import promote
from racelake.operators.partitions import in_partitions, partition_values
from racelake.operators.shape import cast_to, conform
from racelake.schemas import RUN_LOG, names


def read(spark: SparkSession, path: str, fmt: str = "parquet", schema: str | None = None, **options: Any) -> DataFrame:
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def alias(df: DataFrame, name: str) -> DataFrame:
    """The table under another name for the session, without a copy."""
    df.createOrReplaceTempView(name)
    return df


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A few rows given by hand, such as corrections or a log entry; may be none."""
    return spark.createDataFrame(list(rows), schema)


def sql_source_options(
    url: str, name: str, column: str | None = None, bounds: tuple[Any, Any] | None = None,
    partitions: int = 1, query_timeout_s: int = 7200, **more: Any,
) -> dict[str, str]:
    """Options of a JDBC read; with a column and bounds the read is split into parallel ranges."""
    options = {"url": url, "dbtable": name, "queryTimeout": query_timeout_s, **more}
    if column is not None:
        if bounds is None or partitions < 2:
            raise ValueError("a parallel read needs bounds and at least two partitions")
        options |= {
            "partitionColumn": column, "lowerBound": bounds[0], "upperBound": bounds[1], "numPartitions": partitions,
        }
    return {k: str(v) for k, v in options.items()}


def read_sql_source(spark: SparkSession, url: str, name: str, **options: Any) -> DataFrame:
    return spark.read.format("jdbc").options(**sql_source_options(url, name, **options)).load()


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Replace a table; its schema may change. The source must not be read from the same path."""
    df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").partitionBy(*partition_by).save(path)


def overwrite_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet", touched: Iterable[tuple] = (),
) -> None:
    """Replace only the partitions that occur in ``df``, and those named as ``touched``; all others stay as they are.

    A correction of one season rewrites that season's files, not the table. A touched partition of which ``df``
    has no row is left without rows.
    """
    named = set(map(tuple, touched))
    left = set(map(tuple, df.select(*partition_by).distinct().collect())) if named else set()
    writer = df.write.format(fmt).mode("overwrite").partitionBy(*partition_by)
    writer.option("partitionOverwriteMode", "dynamic").save(path)
    nothing = df.drop(*partition_by).filter(F.lit(False))
    for values in sorted(named - left, key=str):
        folder = "/".join(f"{c}={v}" for c, v in zip(partition_by, values))
        nothing.sparkSession.createDataFrame([], nothing.schema).write.format(fmt).mode("overwrite").save(f"{path}/{folder}")


def append(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    df.write.format(fmt).mode("append").partitionBy(*partition_by).save(path)


def save_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """Write a table of the catalog."""
    df.write.format(fmt).mode(mode).option("overwriteSchema", "true").saveAsTable(name)


def promote_table(
    spark: SparkSession, staging: str, base: str, schema: str, keys: Sequence[str],
    fmt: str = "parquet", partition_by: Sequence[str] = (),
) -> None:
    """Append the new races of a staging table to its base table, cast to the base schema.

    Of a partitioned base only the partitions of the incoming rows are read: a key belongs to one of them.
    """
    incoming, known = cast_to(read(spark, staging, fmt), schema), read(spark, base, fmt)
    if partition_by:
        known = known.filter(in_partitions(partition_by, partition_values(incoming, partition_by)))
    append(promote(incoming, known, keys), base, fmt, partition_by)


def promote_tables(
    spark: SparkSession, pairs: Mapping[str, tuple[str, str]], schemas: Mapping[str, str], keys: Sequence[str], **how: Any
) -> None:
    """Promote a set of tables, given as ``name -> (staging path, base path)``."""
    for name, (staging, base) in pairs.items():
        promote_table(spark, staging, base, schemas[name], keys, **how)


def publish(spark: SparkSession, source: str, target: str, fmt: str = "parquet") -> None:
    """Copy a dimension to the next layer, replacing it and its schema."""
    overwrite(read(spark, source, fmt), target, fmt)


def back_up(spark: SparkSession, name: str, backup: str) -> None:
    save_table(spark.table(name), backup, mode="errorifexists")


def migrate_types(spark: SparkSession, name: str, backup: str, schema: str) -> None:
    """Give a catalog table a new schema: back it up, recreate it empty, reload it."""
    back_up(spark, name, backup)
    save_table(spark.createDataFrame([], schema), name)
    conform(spark.table(backup), schema).write.insertInto(name)


def log_run(
    spark: SparkSession, path: str, started: datetime, ended: datetime, fmt: str = "parquet", **details: Any
) -> None:
    """Append one row to the run log; details are named after the log's columns."""
    append(run_log_row(spark, started, ended, **details), path, fmt)


def run_log_row(spark: SparkSession, started: datetime, ended: datetime, **details: Any) -> DataFrame:
    known = names(RUN_LOG)
    unknown = set(details) - set(known)
    if unknown:
        raise ValueError(f"the run log has no column {sorted(unknown)}")
    row = {"Datetime_Star": started, "Datetime_end": ended, **details}
    return literal_rows(spark, [tuple(row.get(c) for c in known)], RUN_LOG)


def run_step(
    df: DataFrame, write: Callable[[DataFrame], None], log: str, metrics: Mapping[str, Column] | None = None,
    fmt: str = "parquet", **details: Any,
) -> dict[str, Any]:
    """Write a step's rows and log the run, with figures taken while the rows are written: no second pass.

    ``metrics`` are further aggregates over the rows. All figures go to the log's comment and are returned.
    """
    counted, started = Observation(), datetime.now(timezone.utc).replace(tzinfo=None)
    aggregates = {"rows": F.count(F.lit(1)), **(metrics or {})}
    write(df.observe(counted, *(column.alias(name) for name, column in aggregates.items())))
    figures = counted.get
    comment = ", ".join(f"{name}={figures[name]}" for name in aggregates)
    ended = datetime.now(timezone.utc).replace(tzinfo=None)
    log_run(df.sparkSession, log, started, ended, fmt, Coment=comment, **details)
    return figures
