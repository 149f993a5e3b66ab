"""Token-ID / binary output: per-document zstandard frames with a shared dictionary.

File format (Parquet, written by Spark's committers to any store Spark reaches):

* ``dictionary`` - one row: the zstandard dictionary and its SHA-256,
* ``blocks`` - one row per block of consecutive documents: ``part``, ``block``
  (their order is ascending doc_id order), ``dict_sha256``, ``first_id`` and
  ``last_id`` (a range filter that reaches the Parquet reader), the offset
  index (``doc_ids``, ``offsets`` into ``frames``, ``n_tokens``), and
  ``frames``: the documents' compressed ids one after another.

A frame holds the ids of one document as little-endian unsigned 32-bit
integers, so one document is read by one range filter and one decompression.
The dictionary is trained on the ids of a bounded sample (``DICT_DOCS``
documents expected, ``DICT_SAMPLE_BYTES`` of each); it changes file sizes, never
results.

Defined cases: null and empty texts hold the end id alone; a null doc_id sorts
first; rows that share a doc_id follow each other (by a hash of their text),
repeated rows are written as often as they occur; an empty table gives files
without blocks.  Ties are dealt over many partitions, so a repeated doc_id is
no hot task.  Texts of any length are written whole; other columns are not read,
so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.functions import pandas_udf

from ledgerlens.llm.textual import WORD_PIECES, Cache, byte_symbols, is_plain, library_tokenizer

DICT_DOCS = 1_000
DICT_SAMPLE_BYTES = 32_768
DICT_BYTES = 65_536
BLOCK_BYTES = 1 << 20
BLOCK_DOCS = 4_096
LEVEL = 3

_BLOCKS = ("part int, block int, dict_sha256 string, first_id long, last_id long, first_token long, "
           "doc_ids array<long>, offsets array<long>, n_tokens array<long>, frames binary")


class LibraryIds:
    """Ids of whole texts by the tokenizers library.  White-space separated
    chunks never share a token, so the library's model encodes each distinct
    chunk once; texts that are not plain go through the library whole."""

    def __init__(self, path: str):
        self.tok, self.symbols = library_tokenizer(path), byte_symbols()
        self.model = self.tok.model
        self.chunk_ids = Cache(self._chunk, 500_000)

    def _chunk(self, chunk: str) -> bytes:
        pieces = [chunk] if chunk.isalpha() else WORD_PIECES.findall(chunk)
        if len(pieces) > 1:
            # a word with its punctuation: the word alone is usually known
            return b"".join(map(self.chunk_ids.__getitem__, pieces))
        piece = pieces[0]
        spelled = piece if piece.isascii() else "".join(self.symbols[b] for b in piece.encode("utf-8"))
        ids = [t.id for t in self.model.tokenize(spelled)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        if "<|" not in text and is_plain(text):
            return b"".join(map(self.chunk_ids.__getitem__, text.lower().split()))
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@lru_cache(maxsize=2)
def library_ids(path: str) -> LibraryIds:
    return LibraryIds(path)


def train_dictionary(docs: DataFrame, path: str) -> bytes:
    """Dictionary bytes from the serialized ids of a hash-chosen bounded sample."""
    total = docs.count()
    if not total:
        return b""
    slots = 1 << 30
    share = min(slots, slots * DICT_DOCS // total + 1)

    @pandas_udf("binary")
    def head(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = library_ids(path)
        for batch in batches:
            yield pd.Series([own.encode(t or "")[:DICT_SAMPLE_BYTES] for t in batch], dtype=object)

    # a repeated row is picked as often as it occurs, hence the limit
    picked = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(slots)) < share).limit(4 * DICT_DOCS).select(
        head("text").alias("ids"))
    samples = sorted(bytes(r.ids) for r in picked.collect() if r.ids)
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        # too few samples to train on: their plain content serves as the dictionary
        return b"".join(samples)[:DICT_BYTES]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if len(raw) >= 8 else None


def write_id_files(docs: DataFrame, path: str, out_dir: str, end_id: int = 1, id_col: str = "doc_id",
                   text_col: str = "text") -> None:
    """Encode every whole text, append ``end_id``, write the files under ``out_dir``."""
    spark = docs.sparkSession
    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    raw = train_dictionary(kept, path)
    digest = hashlib.sha256(raw).hexdigest()
    spark.createDataFrame([(digest, bytearray(raw))], "dict_sha256 string, dictionary binary") \
        .write.parquet(f"{out_dir}/dictionary")
    end = int(end_id).to_bytes(4, "little")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own = TaskContext.get().partitionId(), library_ids(path)
        known = _dictionary(raw)
        squeeze = zstandard.ZstdCompressor(level=LEVEL, dict_data=known) if known else zstandard.ZstdCompressor(LEVEL)
        block, before = 0, 0
        ids, counts, frames, held = [], [], [], 0

        def row() -> pa.RecordBatch:
            offsets = np.concatenate(([0], np.cumsum([len(f) for f in frames])))
            cells = ([part], [block], [digest], [ids[0]], [ids[-1]], [before], [ids], [offsets], [counts],
                     [b"".join(frames)])
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()),
                     pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            names = [c.split()[0] for c in _BLOCKS.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], names=names)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                encoded = own.encode(text or "") + end
                ids.append(key)
                counts.append(len(encoded) // 4)
                frames.append(squeeze.compress(encoded))
                held += len(frames[-1])
                if held >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS:
                    yield row()
                    block, before = block + 1, before + sum(counts)
                    ids, counts, frames, held = [], [], [], 0
        if ids:
            yield row()

    # equal doc_ids are told apart by text, and repeated rows by their place, so no range is hot
    dealt = kept.withColumn("tie", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    ordered = dealt.repartitionByRange("doc_id", "tie", "place").sortWithinPartitions("doc_id", "tie", "place")
    ordered.select("doc_id", "text").mapInArrow(blocks, _BLOCKS).write.parquet(f"{out_dir}/blocks")


def _open(spark: SparkSession, out_dir: str) -> tuple[str, bytes]:
    r = spark.read.parquet(f"{out_dir}/dictionary").head()
    raw = bytes(r.dictionary)
    if hashlib.sha256(raw).hexdigest() != r.dict_sha256:
        raise ValueError("the dictionary does not match its hash")
    return r.dict_sha256, raw


def read_id_files(spark: SparkSession, out_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    digest, raw = _open(spark, out_dir)
    blocks = spark.read.schema(_BLOCKS).parquet(f"{out_dir}/blocks")
    # one row per written partition: as many as the writer's shuffle had, whatever the data
    sums = blocks.groupBy("part").agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x))
                                      .alias("tokens"))
    base = sums.select("part", F.coalesce(F.sum("tokens").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _dictionary(raw)
        expand = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
        for batch in batches:
            for r in batch.to_pylist():
                if r["dict_sha256"] != digest:
                    raise ValueError("a block was written with another dictionary")
                at, starts, counts, crcs = r["base"] + r["first_token"], [], [], []
                for a, b in zip(r["offsets"], r["offsets"][1:]):
                    ids = expand.decompress(r["frames"][a:b])
                    starts.append(at)
                    counts.append(len(ids) // 4)
                    crcs.append(zlib.crc32(ids))
                    at += counts[-1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in (r["doc_ids"], starts, counts, crcs)],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return blocks.join(F.broadcast(base), "part").select("dict_sha256", "base", "first_token", "doc_ids", "offsets",
                                                         "frames").mapInArrow(
        documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def fetch_document(spark: SparkSession, out_dir: str, doc_id: int) -> list[np.ndarray]:
    """Ids of the document(s) with this id: a pushed-down block filter, then one frame each."""
    digest, raw = _open(spark, out_dir)
    known = _dictionary(raw)
    expand = zstandard.ZstdDecompressor(dict_data=known) if known else zstandard.ZstdDecompressor()
    blocks = spark.read.schema(_BLOCKS).parquet(f"{out_dir}/blocks")
    # null ids sort first, so a block may start with them
    hits = blocks.where((F.col("first_id").isNull() | (F.col("first_id") <= doc_id)) & (F.col("last_id") >= doc_id))
    at = F.posexplode("doc_ids").alias("at", "id")
    rows = hits.select("part", "block", "offsets", "frames", at).where(F.col("id") == doc_id).select(
        "part", "block", "at", F.expr("substring(frames, int(offsets[at]) + 1, int(offsets[at + 1] - offsets[at]))")
        .alias("frame")).orderBy("part", "block", "at")
    return [np.frombuffer(expand.decompress(bytes(r.frame)), dtype="<u4") for r in rows.collect()]
