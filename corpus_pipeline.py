"""Corpus pipeline: quality, near-duplicates, decontamination, secrets, token ids.

Each stage takes the documents its predecessor kept, as Parquet, and works on
all of them.  All but the last return the columns of ``documents``; the last
returns a row per document with the digests of its ids and decoded text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm.decontaminate import decontaminate
from ledgerlens.llm.fm_quality import keep_good
from ledgerlens.llm.native import written
from ledgerlens.llm.order_minhash import keep_one
from ledgerlens.llm.pair_index_bpe import round_trip
from ledgerlens.llm.queries import table
from ledgerlens.llm.secret_index import redact


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine rejects go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays."""
    return redact(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    return round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("bpe_encoding", bpe_encoding),
]

#: Trained models and Order MinHash have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
