"""Byte-level BPE encoding and decoding with overlapping chunks.

A long text is cut into chunks that overlap. All chunks are pre-tokenised in parallel, each from its
own start. The split pattern never looks behind, so as soon as one boundary of a chunk coincides with
a boundary of its predecessor both agree from there on: that position is the seam. The pieces between
seams are encoded by themselves; their ids in order are the ids of the whole text. Decoding
concatenates the bytes of the ids.

Cases: a null or empty text has no ids; repeated rows give repeated results; further columns, whatever their names, are ignored; an empty table gives an empty
one. A text whose chunks share no boundary in an overlap (one word of thousands of letters) is encoded
in one piece, which is the same result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.llm.staging import documents, tidy
from racelake.shipping import ship

RANKS = "byte_bpe_multi_50k.tiktoken"
CHUNK = 16_384
"""characters from one chunk's start to the next"""
OVERLAP = 512
LOOKAHEAD = 3
"""a boundary this close to the end of a chunk may depend on characters beyond it"""

_encodings: dict[str, tiktoken.Encoding] = {}


def encoding(ranks: str) -> tiktoken.Encoding:
    """The encoding of a rank file, loaded once per Python process."""
    if ranks not in _encodings:
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encodings[ranks] = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
        )
    return _encodings[ranks]


def boundaries(text: str, final: bool) -> list[int]:
    """Offsets at which pre-tokens end, as far as they cannot depend on what follows the text."""
    limit = len(text) if final else len(text) - LOOKAHEAD
    ends = (m.end() for m in regex.finditer(public_tokenizers.PATTERN, text))
    return [e for e in ends if e <= limit]


def _ids_type() -> pa.DataType:
    return pa.list_(pa.int32())


def _encoded(texts: Iterable[str | None], ranks: str) -> pa.Array:
    encode = encoding(ranks).encode_ordinary
    return pa.array([encode(t) if t else [] for t in texts], _ids_type())


def _encode_rows(ranks: str):
    """Batches of (key columns..., text): the same with ids in place of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                columns = [part.column(i) for i in range(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, _encoded((t.as_py() for t in part.column(part.num_columns - 1)), ranks)],
                    names=[*part.schema.names[:-1], "ids"],
                )

    return run


def _cut(chunk: int, overlap: int):
    """Rows (row_id, doc_id, text) to (row_id, doc_id, chunk, final, text of the chunk with its overlap)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc, text in zip(*(batch.column(i) for i in range(3))):
                whole = text.as_py()
                starts = range(0, len(whole), chunk)
                texts = [whole[s : s + chunk + overlap] for s in starts]
                final = [s + chunk >= len(whole) for s in starts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row.as_py()] * len(texts), pa.string()), pa.array([doc.as_py()] * len(texts), pa.int64()),
                        pa.array(range(len(texts)), pa.int32()), pa.array(final, pa.bool_()), pa.array(texts, pa.string()),
                    ],
                    names=["row_id", "doc_id", "chunk", "final", "text"],
                )

    return run


def _edges(chunk: int, overlap: int):
    """Boundaries of every chunk in its first ``overlap`` characters and in those it shares with the next.

    One row a chunk and edge: (row_id, seam, head, tail), the edge between chunks ``seam - 1`` and ``seam``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, seams, heads, tails = [], [], [], []
            columns = (batch.column(name) for name in ("row_id", "chunk", "final", "text"))
            for row, number, final, text in zip(*columns):
                row, number, final, text = row.as_py(), number.as_py(), final.as_py(), text.as_py()
                # the text ends within the overlap of the last chunk but one, too
                ends = boundaries(text, final or len(text) < chunk + overlap)
                if number:
                    rows.append(row), seams.append(number)
                    heads.append([e for e in ends if e < overlap]), tails.append(None)
                if not final:
                    rows.append(row), seams.append(number + 1)
                    heads.append(None), tails.append([e - chunk for e in ends if chunk <= e < chunk + overlap])
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.string()), pa.array(seams, pa.int32()), pa.array(heads, _ids_type()), pa.array(tails, _ids_type())],
                names=["row_id", "seam", "head", "tail"],
            )

    return run


def _encode_long(rows: DataFrame, ranks: str, chunk: int, overlap: int) -> DataFrame:
    """Rows (row_id, doc_id, text) whose text is longer than a chunk: (doc_id, ids).

    The text is shuffled once, as chunks. Every branch below reads all columns of ``chunks``, so that
    Spark reuses that one exchange; what else is shuffled are offsets and ids.
    """
    # copies of a row meet here and are encoded once
    chunks = rows.mapInArrow(
        _cut(chunk, overlap), "row_id string, doc_id long, chunk int, final boolean, text string"
    ).groupBy("row_id", "chunk").agg(
        F.first("doc_id").alias("doc_id"), F.first("final").alias("final"), F.first("text").alias("text"),
        F.count("*").alias("copies"),
    )
    edges = chunks.mapInArrow(_edges(chunk, overlap), "row_id string, seam int, head array<int>, tail array<int>")
    seams = edges.groupBy("row_id", "seam").agg(
        F.first("head", True).alias("head"), F.first("tail", True).alias("tail")
    ).select("row_id", "seam", F.array_min(F.array_intersect("head", "tail")).alias("at"))
    # one narrow row a text, then one a chunk; a text with a seam that was not found is encoded whole
    bounds = seams.groupBy("row_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("seam", "at"))), lambda s: s["at"]).alias("at"),
    ).select(
        "row_id", F.exists("at", F.isnull).alias("broken"),
        F.posexplode(F.arrays_zip(F.concat(F.array(F.lit(0)), "at").alias("from"), "at")).alias("chunk", "seam"),
    ).select("row_id", "chunk", "broken", F.col("seam.from").alias("from"), F.col("seam.at").alias("to"))
    parts = chunks.join(bounds, ["row_id", "chunk"]).select(
        "row_id", "doc_id", "chunk", "copies", "broken",
        F.when(F.col("broken"), F.col("text").substr(1, chunk))
        .otherwise(F.col("text").substr(
            F.col("from") + 1, F.when(F.col("final"), F.length("text")).otherwise(F.col("to") + chunk) - F.col("from")
        )).alias("piece"),
    )
    shape = "row_id string, doc_id long, copies long, ids array<int>"
    stitched = (
        parts.filter("not broken").select("row_id", "doc_id", "copies", "chunk", "piece")
        .mapInArrow(tidy(_encode_rows(ranks)), "row_id string, doc_id long, copies long, chunk int, ids array<int>")
        .groupBy("row_id").agg(
            F.first("doc_id").alias("doc_id"), F.first("copies").alias("copies"),
            F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "ids"))), lambda c: c["ids"])).alias("ids"),
        )
    )
    whole = (
        parts.filter("broken").groupBy("row_id").agg(
            F.first("doc_id").alias("doc_id"), F.first("copies").alias("copies"),
            F.concat_ws("", F.transform(F.sort_array(F.collect_list(F.struct("chunk", "piece"))), lambda c: c["piece"])).alias("text"),
        ).mapInArrow(tidy(_encode_rows(ranks)), shape)
    )
    once = stitched.unionByName(whole)
    return once.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("doc_id", "ids")


def encode(docs: DataFrame, ranks: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text), by the ranks in the given file."""
    if not 8 <= overlap <= chunk:
        raise ValueError("the overlap must be at least 8 characters and at most a chunk")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    short = rows.filter(F.length("text") <= chunk).mapInArrow(tidy(_encode_rows(ranks)), "doc_id long, ids array<int>")
    key = F.sha2(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "text"), 256)
    long = rows.filter(F.length("text") > chunk).select(key.alias("row_id"), "doc_id", "text")
    return short.unionByName(_encode_long(long, ranks, chunk, overlap))


def _digest(ranks: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(ranks)
        decimal = [b"%d" % i for i in range(coder.n_vocab)]
        for batch in batches:
            lengths, ids_digest, decoded_digest = [], [], []
            for ids in batch.column("ids"):
                ids = ids.values.to_pylist() if ids.is_valid else []
                lengths.append(len(ids))
                ids_digest.append(hashlib.sha256(b",".join(map(decimal.__getitem__, ids))).hexdigest())
                decoded_digest.append(hashlib.sha256(coder.decode_bytes(ids)).hexdigest())
            ids = [batch.column("ids")] if with_ids else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(lengths, pa.int64()), pa.array(ids_digest, pa.string()), pa.array(decoded_digest, pa.string()), *ids],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids],
            )

    return run


def _decode(ranks: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(ranks)
        for batch in batches:
            decoded = [coder.decode_bytes(ids.as_py() or []) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(decoded, pa.binary())], names=["doc_id", "bytes"])

    return run


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """(doc_id, bytes) of rows (doc_id, ids): the bytes of the ids, concatenated; null ids have none."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(ranks), "doc_id long, bytes binary")


def digests(encoded: DataFrame, ranks: str, with_ids: bool = False) -> DataFrame:
    """Token count, digest of the decimal ids and digest of the decoded bytes of rows (doc_id, ids)."""
    shape = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return encoded.select("doc_id", "ids").mapInArrow(tidy(_digest(ranks, with_ids)), shape)


def query(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path(RANKS)
    return digests(encode(documents(ship(spark), folder), ranks), ranks)
