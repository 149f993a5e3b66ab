"""Cross-tokenizer alignment: groups of tokens of two tokenizers over the same bytes.

A is a byte-level BPE that reads a space and the text, B a sentencepiece model
that reads the text and puts the space in front itself.  A byte offset where a
token of each ends is a shared cut.  Groups are found by divide and conquer:
the end of a token of A nearest the middle that B has as well, found by
bisection, splits an interval in two; an interval without such an end is a
group.  All A-B pairs of occurrences inside a group are links.

How many documents hold a pair linked is counted over the whole table: workers
turn ``BLOCK_CHARS`` of text at a time into one row that keeps each document's
distinct pairs as places in the block's own sorted list of pairs; the lists of
all blocks are summed by pair, and the sums go back to the blocks that hold the
pair.  So a pair crosses the network once a block, not once a document, and no
table of all pairs is ever in one place.

Plain texts are read as runs: white space with the word that follows, the marks
behind a word apart.  Neither tokenizer has a token that crosses the start of
such a run, so a run's groups are found once and kept in the worker's cache;
other texts are encoded whole by the libraries.

Defined cases: null and empty texts, and texts whose joined token bytes are not
those of space and text (an unknown character, U+2581), have no tokens: all
figures are 0 and the digest is ''.  Special strings are plain text.  A null or
repeated doc_id and repeated rows are documents of their own; an empty table
gives no rows; a long text is taken whole, in a block of its own if need be;
columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerlens.llm.native import small_batches, written
from ledgerlens.llm.textual import BYTE_PIECES, Cache, byte_symbols, is_plain, keep_only, tokenizer_spec

#: Code points of the documents of one block; a longer document is a block of its own.
BLOCK_CHARS = 6_000_000
#: Blocks (a few MB each) that a worker receives at once.
BLOCKS_AT_ONCE = 2
#: Runs up to this many code points are kept in the cache.
SHORT_RUN = 64
_B_BITS = 32


def groups_of(ends_a: list[int], ends_b: list[int]) -> list[tuple[int, int, int, int]]:
    """(first a, behind last a, first b, behind last b) of each group, in order.
    Both lists hold the ascending ends of non-empty tokens; their last ends are equal."""
    out, open_ = [], [(0, len(ends_a), 0, len(ends_b))] if ends_a else []
    while open_:
        a0, a1, b0, b1 = open_.pop()
        # the last end is shared anyway; the ends nearest the middle come first
        left, cut = ((a0 + a1) // 2 - 1, None) if b1 - b0 > 1 else (a0 - 1, None)
        right = left + 1 if b1 - b0 > 1 else a1
        while cut is None and (left >= a0 or right < a1 - 1):
            for i in (left, right):
                if a0 <= i < a1 - 1:
                    j = bisect_left(ends_b, ends_a[i], b0, b1 - 1)
                    if j < b1 - 1 and ends_b[j] == ends_a[i]:
                        cut = (i + 1, j + 1)
                        break
            left, right = left - 1, right + 1
        if cut:
            # the left half is next on the stack, so groups come in order
            open_ += [(cut[0], a1, cut[1], b1), (a0, cut[0], b0, cut[1])]
        else:
            out.append((a0, a1, b0, b1))
    return out


#: Groups as text, links as packed 64-bit numbers (A id, B id), and the numbers of A tokens, B tokens and groups.
Aligned = tuple[str, bytes, int, int, int]
_NONE: Aligned = ("", b"", 0, 0, 0)


class Aligner:
    """Both tokenizers and the alignment of one text or run."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.model = self.a.model
        spec = tokenizer_spec(path_a)
        self.symbols = byte_symbols()
        self.space = self.symbols[32]
        of_symbol = {c: b for b, c in enumerate(self.symbols)}
        vocab = spec["model"]["vocab"] | {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_a = [b""] * (1 + max(vocab.values()))
        for token, i in vocab.items():
            own = [of_symbol.get(c) for c in token]
            self.bytes_a[i] = token.encode("utf-8") if None in own else bytes(own)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode("utf-8")
                        for i, p in enumerate(pieces)]
        self.name = [*map(str, range(max(len(self.bytes_a), len(self.bytes_b))))]
        own = [p for i, p in enumerate(pieces) if not self.b.is_byte(i)]
        #: runs are read alone only where no token crosses their start
        self.crossed = {c for p in own for c in p if c.isspace()}
        self.by_run = not any("▁" in p.lstrip("▁") for p in own)
        self.lone_space = self.b.piece_to_id("▁")
        self.line_start = [self.lone_space, self.b.piece_to_id("<0x0A>")]
        #: a word also ends before these marks if B, like A, never joins a letter to them
        marks = "".join(c for c in ".,;:!?" if not any(x.isalpha() and y == c for p in own for x, y in zip(p, p[1:])))
        word = rf"\s*[^\W\d_]+(?=[{re.escape(marks)}])|" if marks else ""
        self.split = re.compile(rf"{word}\s*\S+|\s+").findall
        self.runs = Cache(self.run, 250_000)

    def _aligned(self, ids_a: list[int], ids_b: list[int], spelled: bytes) -> Aligned | None:
        own_a, own_b = [*map(self.bytes_a.__getitem__, ids_a)], [*map(self.bytes_b.__getitem__, ids_b)]
        if b"".join(own_a) != spelled or b"".join(own_b) != spelled:
            return None
        if len(ids_a) == 1 or len(ids_b) == 1:
            groups = [(0, len(ids_a), 0, len(ids_b))]
        else:
            groups = groups_of([*accumulate(map(len, own_a))], [*accumulate(map(len, own_b))])
        text, links, name = [], [], self.name
        for a0, a1, b0, b1 in groups:
            if a1 - a0 == b1 - b0 == 1:
                a, b = ids_a[a0], ids_b[b0]
                text.append(f"{name[a]}|{name[b]}")
                links.append(a << _B_BITS | b)
            else:
                some_a, some_b = ids_a[a0:a1], ids_b[b0:b1]
                text.append(",".join([name[a] for a in some_a]) + "|" + ",".join([name[b] for b in some_b]))
                links += [a << _B_BITS | b for a in some_a for b in some_b]
        return ";".join(text), array("q", links).tobytes(), len(ids_a), len(ids_b), len(groups)

    def run(self, run: str) -> Aligned | None:
        """White space and the word behind it, as it stands in space + text."""
        if run[0] == " " and run.isascii() and run[1:].isalpha():
            ids_a = [t.id for t in self.model.tokenize(self.space + run[1:])]
        else:
            ids_a = [t.id for piece in BYTE_PIECES.findall(run) for t in self.model.tokenize(
                "".join([self.symbols[b] for b in piece.encode("utf-8")]))]
        if run[0] == " ":
            ids_b = self.b.encode(run[1:]) if len(run) > 1 else [self.lone_space]
        else:
            # nothing joins a line end, so what follows it is read as inside a text
            ids_b = self.b.encode("\n" + run)
            if ids_b[:2] != self.line_start:
                return None
            ids_b = ids_b[2:]
        return self._aligned(ids_a, ids_b, run.encode("utf-8"))

    def align(self, text: str) -> list[Aligned]:
        """The aligned parts of one text, in order; no part if it has no tokens."""
        if not text:
            return []
        if self.by_run and is_plain(text) and self.crossed.isdisjoint(text):
            parts = [self.runs[r] if len(r) <= SHORT_RUN else self.run(r) for r in self.split(" " + text)]
            if None not in parts:
                return parts
        whole = " " + text
        try:
            spelled = whole.encode("utf-8")
        except UnicodeEncodeError:
            return []
        found = self._aligned(self.a.encode(whole, add_special_tokens=False).ids, self.b.encode(text), spelled)
        return [found] if found else []


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


_FIGURES = ("n_a", "n_b", "n_groups", "n_links")
_BLOCK_SCHEMA = ("block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
                 "n_links array<long>, groups_sha256 array<string>, n_pairs array<long>, places binary, "
                 "links binary, pairs binary, holders binary")
_BLOCK_TYPES = [pa.int64()] + [pa.list_(pa.int64())] * 5 + [pa.list_(pa.string()), pa.list_(pa.int64())] \
    + [pa.binary()] * 4
_BLOCK_NAMES = [f.split()[0] for f in _BLOCK_SCHEMA.split(", ")]


class _Block:
    """Documents until their block is full."""

    def __init__(self):
        self.ids, self.figures, self.digests, self.keys, self.links, self.chars = [], [], [], [], [], 0

    def add(self, doc_id: int | None, text: str, parts: list[Aligned]) -> None:
        groups, links, n_a, n_b, n_groups = zip(*parts) if parts else ((),) * 5
        every = np.frombuffer(b"".join(links), dtype=np.int64)
        keys, times = np.unique(every, return_counts=True)
        self.ids.append(doc_id)
        self.figures.append((sum(n_a), sum(n_b), sum(n_groups), len(every)))
        self.digests.append(hashlib.sha256(";".join(groups).encode("ascii")).hexdigest() if parts else "")
        self.keys.append(keys)
        self.links.append(times)
        self.chars += len(text)

    def row(self, number: int) -> pa.RecordBatch:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        sizes = [len(k) for k in self.keys]
        pairs, places, holders = np.unique(np.concatenate(self.keys), return_inverse=True, return_counts=True)
        # a document's places ascend; their differences are small numbers
        step = np.diff(places, prepend=0)
        step[np.cumsum([0, *sizes])[:-1][np.array(sizes) > 0]] = places[np.cumsum([0, *sizes])[:-1][np.array(sizes) > 0]]
        cells = [number, self.ids, *map(list, zip(*self.figures)), self.digests, sizes,
                 squeeze(step.astype("<i4").tobytes()), squeeze(np.concatenate(self.links).astype("<i4").tobytes()),
                 pairs.tobytes(), holders.astype("<i8").tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, _BLOCK_TYPES)], names=_BLOCK_NAMES)


def block_table(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row a block of documents (doc_id, text): their figures and their distinct pairs."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number, block = aligner(path_a, path_b), TaskContext.get().partitionId() << 32, _Block()
        keep_only(own.runs)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                if block.ids and block.chars + len(text) > BLOCK_CHARS:
                    yield block.row(number)
                    number, block = number + 1, _Block()
                block.add(doc_id, text, own.align(text))
        if block.ids:
            yield block.row(number)

    return docs.mapInArrow(blocks, _BLOCK_SCHEMA)


def pair_rows(blocks: DataFrame) -> DataFrame:
    """block, pair and holders (documents of the block that hold the pair linked)."""

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, holders in zip(*batch.columns):
                own = np.frombuffer(pairs.as_buffer(), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), block.as_py(), dtype=np.int64)), pa.array(own),
                     pa.array(np.frombuffer(holders.as_buffer(), dtype=np.int64))], names=["block", "pair", "holders"])

    return blocks.select("block", "pairs", "holders").mapInArrow(unpacked, "block long, pair long, holders long")


_OUT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_OUT_NAMES = [f.split()[0] for f in _OUT.split(", ")]


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    kept = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    with small_batches(docs.sparkSession, 256):
        blocks = written(block_table(kept, path_a, path_b), "blocks")
    with small_batches(docs.sparkSession, BLOCKS_AT_ONCE):
        held = written(pair_rows(blocks), "pairs")
    counts = written(held.groupBy("pair").agg(F.sum("holders").alias("docs")), "pair-counts")
    id_a = F.shiftrightunsigned("pair", _B_BITS).alias("a")
    most = counts.groupBy(id_a).agg(F.max("docs").alias("most"))
    marked = counts.withColumn("a", id_a).join(most, "a").select(
        "pair", "docs", (F.col("docs") == F.col("most")).alias("best"))
    # a block has no more pairs than its documents have links, whatever the table
    back = held.select("block", "pair").join(marked, "pair").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("pair", "docs", "best"))).alias("of"))
    told = blocks.drop("pairs", "holders").join(
        back.select("block", F.col("of.docs").alias("docs"), F.col("of.best").alias("best")), "block", "left")

    def figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row in range(batch.num_rows):
                cell = {name: column[row] for name, column in zip(batch.schema.names, batch.columns)}
                sizes = np.array(cell["n_pairs"].values, dtype=np.int64)
                step = np.frombuffer(spread(cell["places"].as_buffer()), dtype="<i4").astype(np.int64)
                links = np.frombuffer(spread(cell["links"].as_buffer()), dtype="<i4").astype(np.int64)
                first = np.concatenate(([0], np.cumsum(sizes)))
                # sums of steps, each document from its own start
                total = np.concatenate(([0], np.cumsum(step)))
                places = total[1:] - np.repeat(total[first[:-1]], sizes)
                n_best, count_sum = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
                if len(step):
                    docs_of = cell["docs"].values.to_numpy(zero_copy_only=False)
                    best_of = cell["best"].values.to_numpy(zero_copy_only=False)
                    by_doc = np.repeat(np.arange(len(sizes)), sizes)
                    np.add.at(n_best, by_doc, links * best_of[places])
                    np.add.at(count_sum, by_doc, links * docs_of[places])
                columns = {"n_best": pa.array(n_best), "count_sum": pa.array(count_sum)}
                yield pa.RecordBatch.from_arrays(
                    [columns[n] if n in columns else cell[n].values for n in _OUT_NAMES], names=_OUT_NAMES)

    with small_batches(docs.sparkSession, BLOCKS_AT_ONCE):
        return written(told.mapInArrow(figures, _OUT), "aligned")
