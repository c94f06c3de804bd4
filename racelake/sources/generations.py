"""A folder whose files were written under different schemas.

Every append is a generation, a folder of its own, in which all files have one schema. Columns may be added,
dropped or change their type from one generation to the next. Readers name the schema they want; each generation
is read under its own and brought to that one, column by column, so filters and pruning still reach the scans.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.operators.shape import conform, union_all
from racelake.sources import stored

GENERATION = "_generation"


def listed(spark: SparkSession, path: str, fmt: str = "parquet") -> list[int]:
    """The generations of a folder; no column of a file is read for that."""
    try:
        rows = spark.read.format(fmt).option("recursiveFileLookup", "false").load(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return []
        raise
    return sorted(r[0] for r in rows.select(GENERATION).distinct().collect())


def append(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> int:
    """Add rows under their own schema, whatever that of the rows before."""
    known = listed(df.sparkSession, path, fmt)
    number = known[-1] + 1 if known else 0
    df.write.format(fmt).mode("errorifexists").partitionBy(*partition_by).save(f"{path}/{GENERATION}={number}")
    return number


def read_one(spark: SparkSession, path: str, number: int, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(f"{path}/{GENERATION}={number}")


def read(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """All generations as one table of the given schema; what does not fit a column's type becomes null."""
    found = [conform(read_one(spark, path, n, fmt), schema) for n in listed(spark, path, fmt)]
    return union_all(found) if found else spark.createDataFrame([], schema)


def migrate(spark: SparkSession, path: str, name: str, schema: str, partition_by: Sequence[str], fmt: str = "parquet") -> int:
    """The folder as a table of the catalog under one schema, a generation at a time; the folder stays as the backup.

    Returns the number of rows moved. Each generation must have as many rows in the table as in the folder.
    """
    stored.create(spark.createDataFrame([], schema), name, partition_by, fmt)
    columns, moved = spark.table(name).columns, 0
    for n in listed(spark, path, fmt):
        source = read_one(spark, path, n, fmt)
        conform(source, schema).select(*columns).write.insertInto(name)
        moved += source.count()
    kept = spark.table(name).agg(F.count("*")).first()[0]
    if kept != moved:
        raise RuntimeError(f"{kept} rows arrived of {moved}")
    return moved
