"""Token ids in directly addressable codes.

An id is split into chunks of ``WIDTHS`` bits, the lowest first. Level 0 holds the lowest chunk of every
id; level n holds a chunk only for the ids that need one. Per level a continuation bitmap says which
ids go on, and a rank directory (set bits before every 512-bit block) turns "how many go on before me"
into one lookup and a popcount inside one block. Any token is read from a handful of bytes, without
decoding its neighbours.

A store is a table of segments, written by Spark: whole documents in ascending doc_id order, as many as
reach ``SEGMENT`` ids (a longer document has a segment of its own). Columns: ``part``, ``seq`` (order),
``start_in_part``, ``n_tokens``, ``doc_ids``, ``lengths`` and ``payload`` (the coded ids).

Payload, little endian: uint32 id count; per level uint32 count, uint32 chunk bytes, then the chunks
(one byte each, or two for 16-bit levels), and except for the last level the bitmap (bit i of byte i/8)
and the directory (uint32 per 64 bytes of bitmap).

Cases: null and empty texts hold the end id alone; rows with the same doc_id are neighbours in the
store, in the order of their text; a null doc_id comes first; further columns are ignored; an empty
table makes an empty store.
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
from racelake.llm.staging import documents, staged, tidy
from racelake.shipping import ship

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
WIDTHS = (8, 8, 16)
"""bits of the levels; together they hold any 32-bit id"""
BLOCK = 64
"""bytes of bitmap per entry of the rank directory"""
SEGMENT = 1 << 18
KNOWN_PIECES = 2_000_000
"""text pieces whose ids a Python process remembers; sorting takes memory beside it"""

_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)

SEGMENTS = (
    "part int, seq int, start_in_part long, n_tokens long, doc_ids array<long>, lengths array<long>, payload binary"
)


def pack(ids: np.ndarray) -> bytes:
    """The coded form of ids (unsigned 32-bit)."""
    out = [np.uint32(len(ids)).tobytes()]
    rest = ids.astype(np.uint32)
    for level, width in enumerate(WIDTHS):
        last = level == len(WIDTHS) - 1
        kind = np.uint8 if width == 8 else np.uint16
        chunks = (rest & np.uint32((1 << width) - 1)).astype(kind)
        out += [np.array([len(chunks), chunks.nbytes], "<u4").tobytes(), chunks.tobytes()]
        if not last:
            on = rest >> np.uint32(width) > 0
            bitmap = np.packbits(on, bitorder="little")
            padded = np.zeros(-(-len(bitmap) // BLOCK) * BLOCK, np.uint8)
            padded[: len(bitmap)] = _POPCOUNT[bitmap]
            per_block = padded.reshape(-1, BLOCK).sum(1, dtype=np.uint32)
            directory = np.concatenate([[0], np.cumsum(per_block, dtype=np.uint32)[:-1]]).astype("<u4") if len(per_block) else per_block
            out += [bitmap.tobytes(), directory.tobytes()]
            rest = rest[on] >> np.uint32(width)
    return b"".join(out)


def _levels(payload) -> list[tuple[np.ndarray, np.ndarray | None, np.ndarray | None]]:
    """Views of (chunks, bitmap, directory) per level; nothing is decoded."""
    at, levels = 4, []
    for level, width in enumerate(WIDTHS):
        count, size = np.frombuffer(payload, "<u4", 2, at)
        at += 8
        chunks = np.frombuffer(payload, np.uint8 if width == 8 else np.uint16, count, at)
        at += int(size)
        if level == len(WIDTHS) - 1:
            levels.append((chunks, None, None))
            continue
        bitmap = np.frombuffer(payload, np.uint8, -(-int(count) // 8), at)
        at += len(bitmap)
        directory = np.frombuffer(payload, "<u4", -(-len(bitmap) // BLOCK), at)
        at += directory.nbytes
        levels.append((chunks, bitmap, directory))
    return levels


def token_at(payload, i: int) -> int:
    """The i-th id of a payload, by one rank per level."""
    if not 0 <= i < int(np.frombuffer(payload, "<u4", 1)[0]):
        raise IndexError(i)
    value = shift = 0
    for (chunks, bitmap, directory), width in zip(_levels(payload), WIDTHS):
        value |= int(chunks[i]) << shift
        if bitmap is None or not bitmap[i >> 3] >> (i & 7) & 1:
            return value
        block = i >> 3 & -BLOCK
        below = int(_POPCOUNT[bitmap[i >> 3] & ((1 << (i & 7)) - 1)])
        i = int(directory[block // BLOCK]) + int(_POPCOUNT[bitmap[block : i >> 3]].sum()) + below
        shift += width
    return value


def unpack(payload) -> np.ndarray:
    """All ids of a payload."""
    levels = _levels(payload)
    value = levels[-1][0].astype(np.uint32)
    for (chunks, bitmap, _), width in zip(levels[-2::-1], WIDTHS[-2::-1]):
        ids = chunks.astype(np.uint32)
        on = np.unpackbits(bitmap, count=len(chunks), bitorder="little").astype(bool)
        ids[on] |= value << np.uint32(width)
        value = ids
    return value


def _write_segments(vocabulary: str):
    """Sorted (doc_id, text) rows of one range to its segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, start = TaskContext.get().partitionId(), 0, 0
        docs: list[int | None] = []
        coded: list[np.ndarray] = []

        def segment() -> pa.RecordBatch:
            ids = np.concatenate(coded)
            row = {
                "part": part, "seq": seq, "start_in_part": start, "n_tokens": len(ids), "doc_ids": docs,
                "lengths": [len(c) for c in coded], "payload": pack(ids),
            }
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds)], names=list(row))

        size = 0
        for batch in batches:
            texts, doc_ids = batch.column("text"), batch.column("doc_id").to_pylist()
            for lo, hi in token_ids.slices(texts):
                ids, counts = token_ids.encode(texts.slice(lo, hi - lo), vocabulary, KNOWN_PIECES)
                whole = np.split(np.insert(ids, np.cumsum(counts), END_ID), np.cumsum(counts + 1)[:-1])
                for doc, code in zip(doc_ids[lo:hi], whole):
                    docs.append(doc)
                    coded.append(code)
                    size += len(code)
                    if size >= SEGMENT:
                        yield segment()
                        seq, start, size, docs, coded = seq + 1, start + size, 0, [], []
        if docs:
            yield segment()

    return run


def write(docs: DataFrame, vocabulary: str, partitions: int | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text), write them to a new store in the shared folder, return its segments."""
    ship(docs.sparkSession)
    partitions = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(partitions, "doc_id").sortWithinPartitions("doc_id", "text")
    return staged(ordered.mapInArrow(tidy(_write_segments(vocabulary)), SEGMENTS), "token-store")


def with_starts(segments: DataFrame) -> DataFrame:
    """Segments with ``start``: the number of ids before them in the whole store.

    Only the totals of the parts, as many as the store was written with, meet in one task.
    """
    totals = segments.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return segments.join(offsets, "part").withColumn("start", F.col("_before") + F.col("start_in_part")).drop("_before")


def _read_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(row["payload"])
            lengths = np.array(row["lengths"], np.int64)
            ends = np.cumsum(lengths)
            parts = [ids[e - n : e].astype("<u4").tobytes() for n, e in zip(lengths, ends)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + ends - lengths, pa.int64()),
                    pa.array(lengths, pa.int64()), pa.array(parts, pa.binary()),
                ],
                names=["doc_id", "start", "n_tokens", "ids"],
            )


def read(segments: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids as little-endian uint32 bytes) of every document of a store."""
    rows = with_starts(segments).select("doc_ids", "lengths", "payload", "start")
    return rows.mapInArrow(_read_documents, "doc_id long, start long, n_tokens long, ids binary")


def tokens_at(segments: DataFrame, positions: DataFrame) -> DataFrame:
    """(position, token) of global positions, reading only the levels' bytes at each of them.

    A position meets its segment by the part that covers it and a range test inside that part.
    """
    starts = with_starts(segments)
    parts = starts.groupBy("part").agg(F.min("start").alias("_lo"), F.max(F.col("start") + F.col("n_tokens")).alias("_hi"))
    at = positions.select(F.col("position").cast("long").alias("position"))
    placed = at.join(parts, (F.col("position") >= F.col("_lo")) & (F.col("position") < F.col("_hi")))
    wanted = placed.join(starts.select("part", "start", "n_tokens", "payload"), "part").filter(
        (F.col("position") >= F.col("start")) & (F.col("position") < F.col("start") + F.col("n_tokens"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("position").to_pylist(), batch.column("start").to_pylist(), batch.column("payload"))
            found = [(p, token_at(x.as_buffer(), p - s)) for p, s, x in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())],
                names=["position", "token"],
            )

    return wanted.select("position", "start", "payload").mapInArrow(run, "position long, token long")


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crcs = [zlib.crc32(ids.as_buffer()) for ids in batch.column("ids")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(crcs, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def query(spark: SparkSession, folder: str) -> DataFrame:
    store = write(documents(spark, folder), public_tokenizers.path(VOCABULARY))
    return read(store).mapInArrow(_crc, "doc_id long, start long, n_tokens long, ids_crc32 long")
