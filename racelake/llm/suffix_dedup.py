"""Removal of repeated byte strings by a join of fingerprints behind a difference-cover filter.

A byte goes if it is covered by a string of ``width`` bytes that also starts in a document with a smaller
id. Suffixes with the same leading ``width`` bytes are occurrences of one string, and the smallest document that
holds it keeps it. They meet by a fingerprint of those bytes, bucket by bucket.

Joining every suffix would move many times the text. A difference cover avoids that: of ``PERIOD`` places
those in the cover are sampled, so that any two places have a distance at which both are sampled. The
cover samples are joined first (by fingerprints of their leading ``width - PERIOD + 1`` bytes), which tells of each,
by one bit, whether another block holds it too. Two suffixes that tie to the full depth have tied samples inside
that depth, so a suffix none of whose samples is tied is settled. Only the others are joined, by fingerprints of
all ``width`` bytes, two that are independent. Samples get no ranks, and suffixes no order: only ties decide the result. Of documents with the same whole text only the smallest takes part.

A bucket is sorted by fingerprint to bring ties together. Suffixes travel packed, by blocks of documents: per block and bucket one row
with the sorted distinct keys, answered by one bit per key. The text itself is written once, bucketed by block, and
is read in place by both joins with the answers.

Memory of a task: one block of ``BLOCK`` bytes and its arrays (or a single longer document), or one suffix bucket, as many of
which are made as keep it at ``BUCKET`` bytes of text.

Cases: a null or empty text has no bytes; documents shorter than ``width`` are kept; rows with the same doc_id
never remove each other's bytes; a null doc_id counts as larger than all others; repeated rows give repeated
results; further columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.llm.shingles import mix
from racelake.llm.staging import documents, staged
from racelake.shipping import ship

WIDTH = 50
PERIOD = 31
BLOCK = 4 << 20
BUCKET = 16 << 20
SAMPLE_BITS = 32
"""bits of a sample's key inside its bucket; samples that seem tied and are not only cost a sort"""
SUFFIX_BITS = 48
CHECK_BITS = 32
"""bits of a suffix's key inside its bucket, and of the second fingerprint that is compared with it: 80 bits and those
of the bucket. With 10**14 bytes of undecided suffixes (2**23 buckets) about 2**-11 pairs of different strings seem tied"""
_NO_ID = np.iinfo(np.int64).max

BLOCKS = "block long, doc_ids array<long>, lengths array<long>, data binary"


def difference_cover(period: int) -> list[int]:
    """The smallest set of residues whose differences are all residues."""
    for size in itertools.count(1):
        if size * (size - 1) + 1 < period:
            continue
        for rest in itertools.combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return list(cover)


COVER = difference_cover(PERIOD)


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, seq, ids, texts, size = TaskContext.get().partitionId(), 0, [], [], 0

    def block() -> pa.RecordBatch:
        columns = [
            pa.array([part << 32 | seq], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
            pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([b"".join(texts)], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["block", "doc_ids", "lengths", "data"])

    for batch in batches:
        for doc, data in zip(batch.column("doc_id").to_pylist(), batch.column("data")):
            data = data.as_py()
            if ids and size + len(data) > BLOCK:
                yield block()
                seq, ids, texts, size = seq + 1, [], [], 0
            ids.append(doc)
            texts.append(data)
            size += len(data)
    if ids:
        yield block()


class Block:
    """The bytes of some documents with what both rounds need of them."""

    def __init__(self, doc_ids: list, lengths: list, data: bytes, width: int, copies: list[int] | None = None):
        self.width = width
        self.ids = np.array([_NO_ID if d is None else d for d in doc_ids], np.int64)
        self.lengths = np.array(lengths, np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.copies = np.array(copies or [], np.int64)
        self.size = len(data)
        padded = data + bytes(8)
        # the 8 bytes from every place on, without a copy
        self.words = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))

    def keys(self, places: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Two independent fingerprints of the leading bytes of suffixes."""
        key, other = np.full(len(places), depth, np.uint64), np.zeros(len(places), np.uint64)
        steps = [*range(0, depth - 7, 8), *([depth - 8] if depth % 8 else [])]
        for i, step in enumerate(steps):
            word = self.words[places + step]
            key = mix(key ^ word)
            other += (word ^ (word >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93 + 2 * i)
        return key, mix(other)

    def owner(self, places: np.ndarray) -> np.ndarray:
        """Index of the document that holds each place."""
        return np.searchsorted(self.starts + self.lengths, places, side="right")

    def samples(self) -> tuple[np.ndarray, int]:
        """The places of the difference cover in every document, and the depth they are ranked to."""
        depth = self.width - PERIOD + 1
        longest = int(self.lengths.max(initial=0))
        offsets = (np.arange(0, longest + PERIOD, PERIOD)[:, None] + np.array(COVER)[None]).ravel()
        counts = np.searchsorted(offsets, self.lengths - depth, side="right")
        counts[self.lengths < self.width] = 0
        counts[self.copies] = 0  # the smallest copy speaks for all
        return np.concatenate([np.zeros(0, np.int64), *(offsets[:c] + s for s, c in zip(self.starts, counts) if c)]), depth

    def undecided(self, tied: np.ndarray) -> np.ndarray:
        """Suffixes of full depth that hold a tied sample."""
        marks = np.zeros(self.size + 1, np.int32)
        np.add.at(marks, np.maximum(tied - PERIOD + 1, 0), 1)
        np.add.at(marks, tied + 1, -1)
        open_ = np.cumsum(marks[:-1]) > 0
        places = np.flatnonzero(open_)
        owner = self.owner(places)
        return places[places + self.width <= (self.starts + self.lengths)[owner]]


def _by_string(codes: np.ndarray, checks: np.ndarray | None, bucket: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal strings together, by bucket and code first, and in it the first of each string."""
    order = np.argsort(codes, kind="stable")
    if bucket is not None:
        order = order[np.argsort(bucket[order], kind="stable")]

    def differs(column: np.ndarray | None) -> np.ndarray | bool:
        return False if column is None else column[order][1:] != column[order][:-1]

    first = np.ones(len(codes), bool)
    first[1:] = differs(codes) | differs(bucket)
    if checks is not None:
        other = differs(checks) if len(codes) else np.zeros(0, bool)
        if (other & ~first[1:]).any():  # one code, two strings: rare
            order = np.lexsort((checks, codes) if bucket is None else (checks, codes, bucket))
            first[1:] = differs(codes) | differs(bucket) | differs(checks)
    return order, first


class Keys:
    """The keys of a block's suffixes: sorted by bucket and key, equal ones together."""

    def __init__(self, fingerprints: tuple[np.ndarray, np.ndarray], owner: np.ndarray, ids: np.ndarray, buckets: int, bits: int, check_bits: int = 0):
        keys = fingerprints[0] >> np.uint64(64 - bits)
        # the check is taken from the upper bits of the second fingerprint, the bucket from the lower ones
        spare = fingerprints[1] & np.uint64((1 << (64 - check_bits)) - 1)
        bucket = (spare % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.uint32)
        checks = (fingerprints[1] >> np.uint64(64 - check_bits)).astype(np.uint32) if check_bits else None
        self.order, first = _by_string(keys, checks, bucket)
        keys, bucket = keys[self.order], bucket[self.order]
        self.group = np.cumsum(first) - 1
        at = np.flatnonzero(first)
        self.doc = ids[owner[self.order]]
        self.least = np.minimum.reduceat(self.doc, at) if len(at) else self.doc
        self.most = np.maximum.reduceat(self.doc, at) if len(at) else self.doc
        self.code, self.bucket = keys[at], bucket[at].astype(np.int64)
        self.check = checks[self.order][at] if check_bits else None

    def rows(self) -> Iterator[tuple[int, slice]]:
        """(bucket, its distinct keys) of the buckets that have any."""
        edges = np.flatnonzero(np.diff(self.bucket, prepend=-1))
        for lo, hi in zip(edges, np.append(edges[1:], len(self.bucket))):
            yield int(self.bucket[lo]), slice(lo, hi)


def _pack(codes: np.ndarray) -> bytes:
    """Sorted numbers as differences in as few bytes as the largest needs."""
    steps = np.diff(codes, prepend=np.uint64(0))
    used = max(1, (int(steps.max()).bit_length() + 7) // 8)
    planes = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :used]
    return bytes([used]) + np.ascontiguousarray(planes).tobytes()


def _unpack(data) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    used = int(raw[0])
    steps = np.zeros(((len(raw) - 1) // used, 8), np.uint8)
    steps[:, :used] = raw[1:].reshape(-1, used)
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)


def _pack_keys(codes: np.ndarray) -> bytes:
    """Sorted keys, some at least: their low bits, and a bitmap in which key i stands at its high part plus i.

    As many low bits as make the whole smallest: about one and a half bits a key beside them.
    """
    n, most = len(codes), int(codes[-1])
    low = min(range(64), key=lambda bits: bits * n + (most >> bits))
    size, rest = divmod(low, 8)
    marks = np.zeros(n + (most >> low), np.uint8)
    marks[(codes >> np.uint64(low)).astype(np.int64) + np.arange(n)] = 1
    raw = codes.astype("<u8").view(np.uint8).reshape(-1, 8)
    odd = raw[:, size, None] >> np.arange(rest, dtype=np.uint8) & np.uint8(1)
    return bytes([low]) + n.to_bytes(4, "little") + b"".join(
        (np.ascontiguousarray(raw[:, :size]).tobytes(), np.packbits(odd).tobytes(), np.packbits(marks).tobytes())
    )


def _unpack_keys(data) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    low, n = int(raw[0]), int.from_bytes(raw[1:5].tobytes(), "little")
    size, rest = divmod(low, 8)
    codes = np.zeros((n, 8), np.uint8)
    edge, end = 5 + n * size, 5 + n * size + -(-n * rest // 8)
    codes[:, :size] = raw[5:edge].reshape(n, size)
    if rest:
        odd = np.unpackbits(raw[edge:end], count=n * rest).reshape(n, rest)
        codes[:, size] = odd @ (1 << np.arange(rest, dtype=np.uint8))
    high = np.flatnonzero(np.unpackbits(raw[end:])) - np.arange(n)
    return codes.view("<u8").ravel() | (high.astype(np.uint64) << np.uint64(low))


def _pack_ids(ids: np.ndarray) -> bytes:
    """A document id per key: the distinct ones as sorted differences, then places among them in as few bits as they need."""
    table, place = np.unique(ids, return_inverse=True)
    width = int(len(table) - 1).bit_length()
    bits = (place.reshape(-1, 1) >> np.arange(width)) & 1
    least = int(table[0])  # may be negative; differences from it are not
    steps = _pack((table.astype(np.uint64) - np.uint64(least & ((1 << 64) - 1))))
    return least.to_bytes(8, "little", signed=True) + len(table).to_bytes(4, "little") + steps + np.packbits(bits.astype(np.uint8)).tobytes()


def _unpack_ids(data: bytes, count: int) -> np.ndarray:
    least, n = int.from_bytes(data[:8], "little", signed=True), int.from_bytes(data[8:12], "little")
    edge = 13 + n * data[12]
    table = (_unpack(data[12:edge]) + np.uint64(least & ((1 << 64) - 1))).view(np.int64)
    width = (n - 1).bit_length()
    bits = np.unpackbits(np.frombuffer(data, np.uint8, offset=edge), count=count * width).reshape(count, width)
    return table[bits.astype(np.int64) @ (1 << np.arange(width, dtype=np.int64))]


def _answers(parts: list[bytes], keys: Keys) -> np.ndarray:
    """The bits of a block's distinct keys, from the answers of the buckets in order."""
    bits = [np.unpackbits(np.frombuffer(p, np.uint8), count=s.stop - s.start) for (_, s), p in zip(keys.rows(), parts, strict=True)]
    return np.concatenate(bits).astype(bool) if bits else np.zeros(0, bool)


def _sample_keys(block: Block, buckets: int) -> tuple[np.ndarray, Keys]:
    places, depth = block.samples()
    return places, Keys(block.keys(places, depth), block.owner(places), block.ids, buckets, SAMPLE_BITS)


def _tied_samples(block: Block, buckets: int, parts: list[bytes]) -> np.ndarray:
    """Places of samples that tie with one of another document, here or in another block."""
    places, keys = _sample_keys(block, buckets)
    tied = _answers(parts, keys) | (keys.least < keys.most)
    return places[keys.order[tied[keys.group]]]


def _blocks_of(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, Block, list[list[bytes]], bytes]]:
    for row in range(batch.num_rows):
        get = {n: batch.column(n)[row].as_py() for n in batch.schema.names}
        answers = [[a["bits"] for a in get[n] or []] for n in batch.schema.names if n.startswith("answers")]
        yield get["block"], Block(get["doc_ids"], get["lengths"], get["data"], width, get["copies"]), answers, get["data"]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks to (block, at, doc_id, digest) of their documents."""
    for batch in batches:
        for row in batch.to_pylist():
            ends = np.cumsum(row["lengths"])
            data = memoryview(row["data"])
            digests = [xxhash.xxh3_128_digest(data[e - n : e]) for n, e in zip(row["lengths"], ends)]
            ids = [_NO_ID if d is None else d for d in row["doc_ids"]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["block"]] * len(ids), pa.int64()), pa.array(range(len(ids)), pa.int32()), pa.array(ids, pa.int64()), pa.array(digests, pa.binary())],
                names=["block", "at", "doc_id", "digest"],
            )


def _copies(blocks: DataFrame) -> DataFrame:
    """(block, copies): per block the places of documents whose whole text a smaller document has."""
    each = staged(blocks.mapInArrow(_texts, "block long, at int, doc_id long, digest binary"), "suffix-texts")
    least = each.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).filter("n > 1").select("digest", "least")
    later = each.join(least, "digest").filter("doc_id > least")
    return staged(later.groupBy("block").agg(F.sort_array(F.collect_list("at")).alias("copies")), "suffix-copies")


def _emit(blocks: list, buckets: list, keys: list, checks: list, docs: list) -> pa.RecordBatch:
    columns = [pa.array(buckets, pa.int32()), pa.array(blocks, pa.int64()), *(pa.array(c, pa.binary()) for c in (keys, checks, docs))]
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "block", "keys", "checks", "docs"])


QUESTIONS = "bucket int, block long, keys binary, checks binary, docs binary"


def _ask_samples(width: int, buckets: int):
    """First round: which keys does another block hold as well?"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, block, _, _ in _blocks_of(batch, width):
                _, keys = _sample_keys(block, buckets)
                rows = [(b, _pack_keys(keys.code[s])) for b, s in keys.rows()]
                yield _emit([number] * len(rows), [r[0] for r in rows], [r[1] for r in rows], [None] * len(rows), [None] * len(rows))

    return run


def _suffix_keys(block: Block, buckets: int, sample_answers: list[bytes]) -> tuple[np.ndarray, Keys]:
    places = block.undecided(_tied_samples(block, buckets, sample_answers))
    return places, Keys(block.keys(places, block.width), block.owner(places), block.ids, buckets, SUFFIX_BITS, CHECK_BITS)


def _suffix_questions(keys: Keys) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """(bucket, keys, checks, first documents) of a block; only the ids that a row needs go with it."""
    for b, s in keys.rows():
        yield b, _pack_keys(keys.code[s]), keys.check[s].astype("<u4").tobytes(), _pack_ids(keys.least[s])


def _ask_suffixes(width: int, buckets: int):
    """Second round: does a smaller document hold the string?"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, block, (samples,), _ in _blocks_of(batch, width):
                _, keys = _suffix_keys(block, buckets, samples)
                rows = list(zip(*_suffix_questions(keys)))
                yield _emit([number] * len(rows[0]), *map(list, rows)) if rows else _emit([], [], [], [], [])

    return run


def _sort_bucket(rows: pa.Table) -> pa.Table:
    """One suffix bucket: sort the keys of all blocks together, answer each with one bit.

    Without documents the bit says that another block holds the key; with them, that a smaller document does.
    """
    blocks = rows.column("block").to_pylist()
    keys = [_unpack_keys(k.as_buffer()) for k in rows.column("keys").combine_chunks()]
    sizes = [len(k) for k in keys]
    whole = np.concatenate(keys)
    ranked = not rows.column("docs").null_count
    checks = np.concatenate([np.frombuffer(c.as_buffer(), "<u4") for c in rows.column("checks").combine_chunks()]) if ranked else None
    order, new = _by_string(whole, checks, None)
    group = np.cumsum(new) - 1
    if ranked:
        docs = rows.column("docs").combine_chunks()
        doc = np.concatenate([_unpack_ids(d.as_py(), n) for d, n in zip(docs, sizes)])[order]
        found = np.minimum.reduceat(doc, np.flatnonzero(new))[group] < doc
    else:
        found = np.bincount(group)[group] > 1
    bits = np.empty(len(whole), bool)
    bits[order] = found
    parts = [np.packbits(b).tobytes() for b in np.split(bits, np.cumsum(sizes)[:-1])]
    return pa.table({"block": pa.array(blocks, pa.int64()), "bucket": rows.column("bucket"), "bits": pa.array(parts, pa.binary())})


def _answered(questions: DataFrame, name: str) -> DataFrame:
    """(block, answers in bucket order), one row per block."""
    replies = staged(questions.groupBy("bucket").applyInArrow(_sort_bucket, "block long, bucket int, bits binary"), name)
    return replies.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "bits"))).alias(name))


def _finish(width: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for _, block, (samples, suffixes), data in _blocks_of(batch, width):
                places, keys = _suffix_keys(block, buckets, samples)
                smaller = _answers(suffixes, keys)[keys.group] | (keys.doc > keys.least[keys.group])
                marks = np.zeros(block.size + 1, np.int32)
                hit = places[keys.order[smaller]]
                marks[hit] += 1  # places are distinct, and so are the ends
                marks[hit + width] -= 1
                whole = block.copies[block.lengths[block.copies] >= width]
                marks[block.starts[whole]] += 1
                marks[(block.starts + block.lengths)[whole]] -= 1  # of documents with bytes, hence distinct
                gone = np.cumsum(marks[:-1]) > 0
                raw = np.frombuffer(data, np.uint8)
                spans, kept = [], []
                for s, n in zip(block.starts, block.lengths):
                    own = gone[s : s + n]
                    if own.any():
                        edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
                        spans.append([{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)])
                        kept.append(raw[s : s + n][~own].tobytes())
                    else:
                        spans.append([])
                        kept.append(data[s : s + n])
                ids = [None if d == _NO_ID else d for d in block.ids.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(block.lengths), pa.array(spans, span), pa.array(kept, pa.binary())],
                    names=["doc_id", "n_bytes", "removed", "kept"],
                )

    return run


def dedup(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_bytes, removed, kept) of every row of ``docs`` (doc_id, text).

    ``removed`` are the maximal removed runs in bytes, ``kept`` the bytes that stay.
    """
    if width < PERIOD + 7:
        raise ValueError(f"strings of less than {PERIOD + 7} bytes need a smaller period")
    spark = ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("data"))
    # bucketed by block, so that the joins below read the text where it is
    name = f"suffix_blocks_{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        rows.mapInArrow(_to_blocks, BLOCKS).write.format("parquet").option("compression", "zstd")
        .bucketBy(parts, "block").sortBy("block").saveAsTable(name)
    )
    blocks = spark.table(name)
    size = blocks.select(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET))
    blocks = blocks.join(_copies(blocks), "block", "left")
    samples = _answered(blocks.mapInArrow(_ask_samples(width, buckets), QUESTIONS), "answers_samples")
    marked = blocks.join(samples, "block", "left")
    suffixes = _answered(marked.mapInArrow(_ask_suffixes(width, buckets), QUESTIONS), "answers_suffixes")
    return marked.join(suffixes, "block", "left").mapInArrow(
        _finish(width, buckets), "doc_id long, n_bytes long, removed array<struct<start: long, end: long>>, kept binary"
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return dedup(documents(ship(spark), folder)).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
