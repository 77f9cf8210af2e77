"""Documents to tokens: five operators of ``starledger.llm``, one after the other.

Each stage gets what its predecessor wrote, works on all of it, and its decisions take effect:
rows that it rejects or secrets that it finds are gone in what it returns. All but the last
return the columns of ``documents``.

Repeated rows go through as rows of their own up to the near-duplicate stage, which keeps one
row of each group. Null texts are empty ones for every stage; null ids stay null, and a group
in which all ids are null keeps one row as well. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from starledger.llm import bpe, quality_model, secret_scan
from starledger.llm.common import stored, table
from starledger.llm.decontaminate import without_copies
from starledger.llm.simhash import without_near_duplicates

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Least score of a document that stays; a score of 1 means label 1.
LEAST_QUALITY = 0.3
#: Near-duplicates: words of a shingle, and most bits in which two fingerprints differ.
SHINGLE_WORDS, MAX_BITS = 4, 4
VOCABULARY = "byte_bpe_50k.tiktoken"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores ``LEAST_QUALITY`` or more."""
    model = quality_model.fit(docs, table(spark, sf_dir, "labels"))
    return quality_model.score(docs, model).where(F.col("score") >= LEAST_QUALITY).select(COLUMNS)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    kept = without_near_duplicates(docs, shingle_words=SHINGLE_WORDS, max_bits=MAX_BITS)
    return kept.select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    return without_copies(docs, table(spark, sf_dir, "benchmark")).select(COLUMNS)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, a mark in the place of each secret; ``n_chars`` is that of the new text."""
    clean = secret_scan.redact(docs)
    same = F.length("text").cast("long")
    return clean.withColumn("n_chars", F.coalesce(same, F.col("n_chars"))).select(COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids`` and ``decoded_sha256`` of each document."""
    ranks = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
    done = bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True)
    return done.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_duplicate),
    ("benchmark_decontamination", decontamination),
    ("secret_scan", secrets),
    ("byte_level_bpe", tokens),
]

#: The quality model has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each from the stored rows of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
