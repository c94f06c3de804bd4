"""Intermediate tables in the folder that the driver and all executors share, and the memory of Python workers."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

PIECE = 2 << 20
"""bytes of text that a Python stage holds as strings at a time, or one longer text"""


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``, or a folder of the warehouse where it is unset."""
    return spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staged"


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def free_name(columns: Iterable[str], name: str) -> str:
    """The name, with as many more underscores in front as it takes to differ from all columns."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def pieces(batch: pa.RecordBatch, size: int = PIECE) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most ``size`` bytes of its column ``text``, a longer text by itself."""
    lo = held = 0
    for i, n in enumerate(pc.binary_length(batch.column("text")).fill_null(0).to_pylist()):
        if i > lo and held + n > size:
            yield batch.slice(lo, i - lo)
            lo, held = i, 0
        held += n
    if lo < batch.num_rows:
        yield batch.slice(lo)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A Python stage that gives memory back when a task ends; the worker's process lives on for other stages."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return wrapped
