"""Packing of documents into training sequences by power-of-two decomposition.

A document of n ids is cut into pieces as n is written in binary: as many of the full length as fit, then one
for every set bit of what is left, the longest first. A piece is a sequence by itself: no sequence crosses
documents, none is padded, and all sequences of one length form a bucket from which batches of one shape
are drawn. Sequences are numbered without gaps, bucket after bucket, the longest bucket first, so a bucket
is a range of numbers.

Every text is encoded once, where it is read. What is counted across tasks is one row per task and bucket.

Cases: null and empty texts hold the end id alone, a piece of length 1; repeated rows are packed like any
other row; a null doc_id is kept; further columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from racelake.llm import token_ids
from racelake.llm.staging import documents, staged
from racelake.shipping import ship

VOCABULARY = "byte_bpe_50k.json"
END_ID = 1
LENGTH = 2048

_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()),
        ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32())), ("part", pa.int32()), ("nth", pa.int64()),
    ]
)
_PIECES = (
    "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, ids array<int>, part int, nth long"
)


def decompose(sizes: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, length) of all pieces of documents of the given sizes, in the order of their ids."""
    full = sizes // longest
    doc = [np.repeat(np.arange(len(sizes)), full)]
    start = [(np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full)) * longest]
    length = [np.full(int(full.sum()), longest)]
    bit = longest >> 1
    while bit:
        has = np.flatnonzero(sizes & bit)
        doc.append(has)
        start.append(sizes[has] & -(bit << 1))  # what the longer pieces hold
        length.append(np.full(len(has), bit))
        bit >>= 1
    doc, start, length = (np.concatenate(x).astype(np.int64) for x in (doc, start, length))
    order = np.lexsort((start, doc))
    return doc[order], start[order], length[order]


def _cut(vocabulary: str, longest: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, taken = TaskContext.get().partitionId(), np.zeros(longest.bit_length(), np.int64)
        for batch in batches:
            texts, doc_ids = batch.column("text"), batch.column("doc_id")
            for lo, hi in token_ids.slices(texts):
                ids, counts = token_ids.encode(texts.slice(lo, hi - lo), vocabulary)
                ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
                sizes = counts + 1
                doc, start, length = decompose(sizes, longest)
                bucket = np.log2(length).astype(np.int64)
                nth = np.empty(len(length), np.int64)
                for b in np.unique(bucket):
                    here = bucket == b
                    nth[here] = taken[b] + np.arange(here.sum())
                    taken[b] += here.sum()
                ends = np.cumsum(length)
                raw = memoryview(ids.tobytes())
                crcs = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), length.tolist())]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids.view("<i4"))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.take(pa.array(doc + lo)), pa.array(start), pa.array(length), pa.array(sizes[doc]), pa.array(crcs, pa.int64()), lists,
                        pa.array(np.full(len(doc), part, np.int32)), pa.array(nth),
                    ],
                    schema=_SCHEMA,
                )

    return run


def pack(docs: DataFrame, vocabulary: str, longest: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """The sequences of ``docs`` (doc_id, text): one row per piece, with its ids.

    Columns: doc_id, start (ids of the document before the piece), length (a power of two, at most ``longest``),
    doc_tokens (with the end id), ids, ids_crc32, sequence_id and offset (always 0: a sequence is one piece).
    """
    if longest < 1 or longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")
    ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = staged(rows.mapInArrow(_cut(vocabulary, longest, end_id), _PIECES), "packed-pieces")
    counted = pieces.groupBy("length", "part").agg(F.count("*").alias("_n"))
    # a bucket's parts follow one another, the buckets follow one another: at most one row per bucket there
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    longer = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    totals = counted.groupBy("length").agg(F.sum("_n").alias("_all"))
    first = totals.select("length", F.coalesce(F.sum("_all").over(longer), F.lit(0)).alias("_first"))
    bases = (
        counted.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).join(first, "length")
        .select("length", "part", (F.col("_first") + F.col("_before")).alias("_base"))
    )
    return pieces.join(bases, ["length", "part"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("_base") + F.col("nth")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"), "ids",
    )


def write(packed: DataFrame, path: str) -> None:
    """Sequences as files, a folder per length (``length=...``), each file in the order of ``sequence_id``."""
    ordered = packed.repartitionByRange("sequence_id").sortWithinPartitions("sequence_id")
    ordered.write.mode("errorifexists").partitionBy("length").parquet(path)


def read(spark: SparkSession, path: str, length: int | None = None) -> DataFrame:
    """The sequences of a folder; with a length, those of that bucket, reading nothing else."""
    rows = spark.read.parquet(path)
    return rows if length is None else rows.filter(F.col("length") == length)


def query(spark: SparkSession, folder: str) -> DataFrame:
    packed = pack(documents(spark, folder), public_tokenizers.path(VOCABULARY))
    return packed.drop("ids")
