"""Language of texts by the nearest centroid of TF-IDF n-gram vectors.

A text becomes the counts of its byte trigrams (lower case, everything but letters a space, hashed to
``DIMS`` dimensions), dampened, weighted by inverse document frequency and scaled to length one. Every
language has several centroids, found by spherical k-means. A text gets the language of the centroid
with the highest cosine; it is rejected where that centroid is further away than texts of its language
are.

Document frequencies cover every labelled row. The centroids are fitted on about ``SAMPLE`` different
labelled texts a language (all, if there are fewer), chosen by a hash of the text; how often a text is
repeated does not matter. How far texts of a language lie from its centroids is measured on texts left
out when fitting (``FOLDS``); a language with a single text takes the smallest bound of the others.

Cases: a null text and one without a letter are ``und`` with score 0 and rejected; without any labelled
row everything is ``und``; repeated rows give repeated results; ties go to the language that sorts
first; further columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from racelake.llm.staging import documents, pieces, tidy
from racelake.shipping import ship

DIMS = 1 << 13
CENTROIDS = 4
SAMPLE = 400
"""different labelled texts a language (expected) that the centroids are fitted on"""
COUNT_ERROR = 0.02
"""relative standard deviation of the number of different texts"""
FOLDS = 5
ROUNDS = 8
SLACK = 0.5
"""a text is rejected below this share of the cosine that nearly all texts of the language reach"""
FULL = 1000
"""trigrams from which that bound holds in full; shorter texts fill few dimensions, their bound falls with the root"""
UNKNOWN = "und"

_SPACED = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
_LETTER = re.compile(r"[^\W\d_]")
_STEP = 1 << 20
"""bytes that are counted at a time"""
_ROWS = 64


def counts(texts: list[str]) -> np.ndarray:
    """Trigram counts, one row per text."""
    out = np.zeros((len(texts), DIMS), np.float32)
    pending: list[tuple[int, bytes]] = []
    size = 0

    def flush() -> None:
        data = np.frombuffer(b"".join(p for _, p in pending), np.uint8).astype(np.uint32)
        lengths = np.array([len(p) for _, p in pending])
        row = np.repeat(np.arange(len(pending)), lengths)
        gram = data[:-2] << 16 | data[1:-1] << 8 | data[2:]
        bucket = (gram * np.uint32(2654435761)) >> np.uint32(32 - DIMS.bit_length() + 1)
        inside = (row[:-2] == row[2:]) & (data[1:-1] != 32)
        flat = np.bincount(row[:-2][inside] * DIMS + bucket[inside], minlength=len(pending) * DIMS)
        for i, (slot, _) in enumerate(pending):
            out[slot] += flat[i * DIMS : (i + 1) * DIMS]
        pending.clear()

    for slot, text in enumerate(texts):
        data = b" " + text.lower().encode("utf-8", "replace").translate(_SPACED) + b" "
        for at in range(0, max(1, len(data) - 2), _STEP):
            pending.append((slot, data[at : at + _STEP + 2]))
            size += len(pending[-1][1])
            if size >= _STEP:
                flush()
                size = 0
    if pending:
        flush()
    return out


def vectors(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Weighted vectors of length one, from trigram counts."""
    rows = np.log1p(found) * idf
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


class Model(NamedTuple):
    idf: np.ndarray
    languages: list[str]
    centroids: np.ndarray
    """one row per centroid"""
    owner: np.ndarray
    """index of each centroid's language"""
    floor: np.ndarray
    """per language, the cosine below which a text is rejected"""


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = np.zeros(DIMS, np.int64), 0
    for piece in (p for batch in batches for p in pieces(batch)):
        texts = piece.column("text").to_pylist()
        rows += len(texts)
        for lo in range(0, len(texts), _ROWS):
            total += (counts(texts[lo : lo + _ROWS]) > 0).sum(0)
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array([[rows, *total]], pa.list_(pa.int64()))], names=["n"])


def _clusters(rows: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means, started from rows far apart."""
    chosen = [int(np.argmax(rows @ rows.mean(0)))]
    while len(chosen) < min(k, len(rows)):
        chosen.append(int(np.argmin((rows @ rows[chosen].T).max(1))))
    centres = rows[chosen]
    for _ in range(ROUNDS):
        nearest = np.argmax(rows @ centres.T, axis=1)
        sums = np.stack([rows[nearest == i].sum(0) if (nearest == i).any() else centres[i] for i in range(len(centres))])
        centres = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
    return centres


def _reach(rows: np.ndarray, k: int) -> float | None:
    """The cosine that nearly all rows reach to centroids of the others; None for a single row."""
    if len(rows) < 2:
        return None
    fold = np.arange(len(rows)) % FOLDS
    apart = [(rows[fold == i] @ _clusters(rows[fold != i], k).T).max(1) for i in range(min(FOLDS, len(rows)))]
    return float(np.quantile(np.concatenate(apart), 0.01))


def _fit_language(idf: np.ndarray, k: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["chance", "text"])
        own = vectors(counts(rows["text"].tolist()), idf).astype(np.float32)
        own = own[np.linalg.norm(own, axis=1) > 0]
        if not len(own):
            return pd.DataFrame({"lang": [], "centroids": [], "reach": []})
        centres = _clusters(own, k).astype(np.float32)
        reach = _reach(own, k)
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "centroids": [centres.tobytes()], "reach": [reach]})

    return run


def fit(labelled: DataFrame, centroids: int = CENTROIDS, sample: int = SAMPLE) -> Model:
    """Learn from rows (text, lang); rows without either are left out.

    To the driver go one number per dimension, one per language, and the centroids.
    """
    ship(labelled.sparkSession)
    rows = labelled.select("text", "lang").filter("text is not null and lang is not null")
    totals = rows.select("text").mapInArrow(tidy(_frequencies), "n array<long>").select(F.posexplode("n").alias("at", "n"))
    found = dict(totals.groupBy("at").agg(F.sum("n")).collect())
    n = found.get(0, 0)
    df = np.array([found.get(i + 1, 0) for i in range(DIMS)], np.float64)
    idf = np.log((1 + n) / (1 + df)).astype(np.float32) + 1
    different = F.approx_count_distinct("text", COUNT_ERROR)
    per_language = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(different.alias("n")).collect()}
    if not per_language:
        return Model(idf, [], np.zeros((0, DIMS), np.float32), np.zeros(0, int), np.zeros(0))
    share = F.create_map(*(F.lit(x) for lang, n in per_language.items() for x in (lang, min(1.0, sample / max(n, 1)))))
    # copies share their hash: of equal texts one is taken
    chance = F.pmod(F.xxhash64("text"), F.lit(1 << 52)) / float(1 << 52)
    chosen = rows.withColumn("chance", chance).filter(F.col("chance") < share[F.col("lang")]).distinct()
    shape = "lang string, centroids binary, reach double"
    fitted = chosen.groupBy("lang").applyInPandas(_fit_language(idf, centroids), shape).collect()
    fitted = sorted(fitted, key=lambda r: r["lang"])
    least = min((r["reach"] for r in fitted if r["reach"] is not None), default=0.0)
    centres = [np.frombuffer(r["centroids"], np.float32).reshape(-1, DIMS) for r in fitted]
    return Model(
        idf, [r["lang"] for r in fitted],
        np.concatenate(centres) if centres else np.zeros((0, DIMS), np.float32),
        np.concatenate([np.full(len(c), i) for i, c in enumerate(centres)]) if centres else np.zeros(0, int),
        np.array([SLACK * (least if r["reach"] is None else r["reach"]) for r in fitted]),
    )


def classify(texts: list[str | None], model: Model) -> list[tuple[str, float, bool]]:
    """(language, cosine, accepted) of each text."""
    out: list[tuple[str, float, bool]] = [(UNKNOWN, 0.0, False)] * len(texts)
    known = [i for i, t in enumerate(texts) if t is not None and _LETTER.search(t)]
    if not model.languages:
        return out
    for lo in range(0, len(known), _ROWS):
        part = known[lo : lo + _ROWS]
        found = counts([texts[i] for i in part])
        cosines = vectors(found, model.idf) @ model.centroids.T
        best, share = cosines.argmax(1), np.sqrt(np.minimum(found.sum(1) / FULL, 1))
        for i, b, row, part_of in zip(part, best, cosines, share):
            owner, score = int(model.owner[b]), float(min(max(row[b], 0.0), 1.0))
            out[i] = model.languages[owner], score, bool(score >= model.floor[owner] * part_of)
    return out


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score and accepted; only the text column is looked at."""
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", "accepted")]
    rows = docs.select(*kept)
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # (centroids + 1) * DIMS floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in (p for batch in batches for p in pieces(batch)):
            found = classify(piece.column("text").to_pylist(), shared.value)
            yield pa.RecordBatch.from_arrays(
                [
                    *piece.columns, pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], pa.bool_()),
                ],
                names=[*piece.schema.names, "lang_pred", "score", "accepted"],
            )

    schema = StructType(list(rows.schema)).add("lang_pred", "string").add("score", "double").add("accepted", "boolean")
    return rows.mapInArrow(tidy(run), schema)


def held_out():
    """Rows that are never learnt from; a row without id is not one of them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(ship(spark), folder)
    model = fit(docs.filter(~held_out()))
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predict(rows, model).drop("text")
