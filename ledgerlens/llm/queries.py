"""The registered queries: one per operator, each over its whole tables."""

from __future__ import annotations

import uuid
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerlens.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # workers that were not sent the package (--py-files) find it where this process did
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder beside the session's checkpoints, which every executor reaches."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.fm_quality import quality
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables have no paths: a document lies in a directory for each run of
    20 ids inside one for each run of 1000; the first id of a run is the
    LICENSE of its directory."""
    from ledgerlens.llm.license_scan import scan_licences
    far, near = F.expr("string(doc_id div 1000)"), F.expr("string(doc_id div 20)")
    path = F.when(F.col("doc_id") % 1000 == 0, F.concat_ws("/", far, F.lit("LICENSE"))) \
        .when(F.col("doc_id") % 20 == 0, F.concat_ws("/", far, near, F.lit("LICENSE"))) \
        .otherwise(F.concat_ws("/", far, near, F.concat(F.lit("doc"), "doc_id", F.lit(".txt"))))
    return scan_licences(table(spark, sf_dir, "documents"), path)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.prefix_tokens import token_counts
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_secret_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.secret_index import secret_report
    return secret_report(table(spark, sf_dir, "documents"))


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.order_minhash import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.pair_index_bpe import round_trip
    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id and matched words of every document that overlaps a benchmark item."""
    from ledgerlens.llm.decontaminate import contaminated
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(F.max("matched_words").alias("matched_words"))


def op8_llr_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.llr_quality import judge
    return judge(table(spark, sf_dir, "documents"))


def op9_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.id_files import read_id_files, write_id_files
    out = shared_folder(spark, "id-files")
    write_id_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), out)
    return read_id_files(spark, out)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.toxicity import toxicity
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.warc import archive_report, write_warc
    out = shared_folder(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), out)
    return archive_report(spark, out)


def op12_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.cover_tree import hard_negatives
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerlens.llm.token_alignment import align
    return align(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                 public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {
    "op1_quality_fm": op1_quality_fm,
    "op2_license_scan": op2_license_scan,
    "op3_token_counts": op3_token_counts,
    "op4_secret_index": op4_secret_index,
    "op5_order_minhash": op5_order_minhash,
    "op6_bpe_codec": op6_bpe_codec,
    "op7_decontamination": op7_decontamination,
    "op8_llr_quality": op8_llr_quality,
    "op9_id_files": op9_id_files,
    "op10_toxicity": op10_toxicity,
    "op11_warc": op11_warc,
    "op12_cover_tree": op12_cover_tree,
    "op13_token_alignment": op13_token_alignment,
}
