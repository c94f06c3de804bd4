"""Intermediate tables in a folder that the driver and all executors share.

A step whose result several others read, or whose rows must not be computed twice, is written once and read
back. That cuts the lineage and survives lost executors.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What holds while a table is written. A task keeps a file open for each of a few partitions instead of sorting
# its rows by them, and what was shuffled for a write is given back when it is done.
_WRITING = {"spark.sql.maxConcurrentOutputFileWriters": "8", "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``, or a folder of the warehouse where it is unset."""
    return spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staged"


@contextmanager
def writing(spark: SparkSession) -> Iterator[None]:
    """Settings of the session for the time of a write."""
    before = {key: spark.conf.get(key, None) for key in _WRITING}
    for key, value in _WRITING.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def staged(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """The rows written to the shared folder and read back; apart by a few columns, for readers of one part."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    written = df.write.option("compression", "zstd")
    if by:
        written = written.partitionBy(*by).option("parquet.block.size", 32 << 20)  # of several files that are open at once
    with writing(df.sparkSession):
        written.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def table_name(name: str) -> str:
    """A name of the catalog that no other run uses."""
    return f"{name}_{uuid.uuid4().hex[:12]}"
