"""What the two trained classifiers share: the split and the bounded training sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Labelled documents expected in a training sample.
SAMPLE_DOCS = 8_000
#: Bytes of their texts expected at most; a sample of longer texts has fewer of them.
SAMPLE_BYTES = 64_000_000
_SLOTS = 1 << 30


def held_out(doc_id: Column) -> Column:
    """Rows never learnt from: crc32 of the id as text, modulo 4, is 2 (a null id is not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, size: int = SAMPLE_DOCS,
                    recorded: Column | None = None, limit: int = SAMPLE_BYTES) -> DataFrame:
    """doc_id, text, ``recorded`` (null if not given) and ``y`` of about ``size`` labelled documents outside the
    held-out fold, of about ``limit`` bytes at most, picked by a hash of the id.  Null labels do not count; a
    document labelled twice counts once with its smaller label, and one of the
    rows of a repeated doc_id is taken."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))) \
        .groupBy("doc_id").agg(F.min(label).cast("int").alias("y"))
    total = known.count()
    share = min(_SLOTS, _SLOTS * size // total + 1) if total else 0
    # about ``size`` rows of 12 bytes, whatever the tables
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(_SLOTS))
    picked = F.broadcast(known.where(slot < share))
    held = docs.select("doc_id", F.octet_length("text").alias("bytes")).join(picked, "doc_id").agg(
        F.sum("bytes")).first()[0] or 0
    if held > limit:
        picked = F.broadcast(known.where(slot < share * limit // held))
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                      (F.lit(None) if recorded is None else recorded).cast("double").alias("recorded"))
    return own.join(picked, "doc_id").groupBy("doc_id").agg(
        F.min("y").alias("y"), F.min(F.struct("text", "recorded")).alias("of")).select(
        "doc_id", "y", F.col("of.text").alias("text"), F.col("of.recorded").alias("recorded"))
