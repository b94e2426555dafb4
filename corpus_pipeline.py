"""Corpus pipeline: quality rules, near-duplicate removal, pseudonyms for personal data, packing into windows.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept and returns the columns of
``documents`` (the last: packed pieces with their token ids). ``run`` applies them in order, each stage's result written to the
shared work folder and reread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import neardup, packing, pseudonyms, quality
from tidemark.llm.common import materialize, table
from tidemark.llm.queries import BYTE_BPE, PII_KEY


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.quality(docs, docs.columns, only_kept=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (similarity 0.8 or more on five-word shingles)."""
    return neardup.distinct_documents(docs, 80, 100)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms in place of personal data; ``n_chars`` follows the new text."""
    out = pseudonyms.pseudonymize(docs, PII_KEY, docs.columns, found=None).select(docs.columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                             .otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces: doc_id, start, length, ids (binary, unsigned 32-bit), doc_tokens, sequence_id, offset."""
    return packing.pack(docs, BYTE_BPE)


STAGES = [("quality", quality_rules), ("near_dedup", near_dedup), ("pii", pii), ("pack", pack)]
ORACLE_SQL = None  # signatures, permutations and token ids are not SQL; tests/llm/test_pipeline.py checks run() by brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialize(docs)
    return docs
