"""From raw documents to token ids: language, near duplicates, benchmark passages, secrets, encoding.

Each stage takes the documents that the stage before kept, as a table, and returns the documents that it
keeps, with the same columns; the last one returns their token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelake.llm import bpe, decontam, language, ngram_join, secret_scan
from racelake.llm.staging import free_name, staged
from racelake.shipping import ship

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are close enough to some language that the labelled ones teach."""
    model = language.fit(docs)
    # columns that the prediction names as well are put aside
    aside = {c: free_name(docs.columns, f"_own_{c}") for c in docs.columns if c in ("lang_pred", "score", "accepted")}
    known = language.predict(docs.withColumnsRenamed(aside), model).filter("accepted").drop("lang_pred", "score", "accepted")
    return known.withColumnsRenamed({b: a for a, b in aside.items()}).select(*docs.columns)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates."""
    return ngram_join.survivors(docs, SHINGLE_WORDS, SIMILAR_PERCENT)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their text replaced; ``n_chars`` follows the text."""
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of all documents."""
    ranks = public_tokenizers.path(bpe.RANKS)
    return bpe.digests(bpe.encode(docs, ranks), ranks, with_ids=True)


def _shipped(stage):
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(ship(spark), docs, sf_dir)

    return run


STAGES = [
    ("language_id", _shipped(known_language)),
    ("ngram_jaccard_join", _shipped(distinct_texts)),
    ("decontamination", _shipped(without_benchmarks)),
    ("secret_scan", _shipped(without_secrets)),
    ("byte_level_bpe", _shipped(encoded)),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; every result but the last is written and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
