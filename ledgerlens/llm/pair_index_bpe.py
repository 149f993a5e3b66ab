"""BPE encoding and decoding with a pair occurrence index.

The distinct pre-tokens of a slice of a partition are laid end to end as one
symbol array with neighbour links.  An index maps the rank of every adjacent
pair that can merge to all its positions in the array.  Active ranks are taken
in ascending order from a heap; all live positions of the rank merge at once
(left to right where they overlap), the links are closed around the removed
symbols and the pairs that arise are appended to the lists of their ranks.
Every merge of the vocabulary ranks after the merges that make its parts, so
the result is that of merging each pre-token alone.

Defined cases: a null text counts as empty; an empty text has no ids and
decodes to the empty text; special strings become their single id (the
library's default) and decode to their string; repeated rows give repeated
results; an empty table gives no rows; texts of any length are encoded whole; a
null doc_id is kept; only doc_id and text are read, so names of other columns
cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from ledgerlens.llm.textual import (BYTE_CHUNKS, BYTE_PIECES, CACHE_ENTRIES, byte_symbols, forgettable, is_plain,
                                    keep_only, library_tokenizer, slices, special_pattern, special_tokens,
                                    tokenizer_spec)


class PairIndexBpe:
    """Byte-level BPE over a published vocabulary file."""

    def __init__(self, path: str):
        spec = tokenizer_spec(path)
        vocab = spec["model"]["vocab"]
        self.path, self.special, self.special_ids = path, special_pattern(path), special_tokens(path)
        symbols = byte_symbols()
        self.of_symbol = {c: b for b, c in enumerate(symbols)}
        self.byte_ids = np.array([vocab[c] for c in symbols], dtype=np.int64)
        merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in spec["model"]["merges"]]
        left, right, made = (np.array(x, dtype=np.int64) for x in zip(*merges))
        self.shift = int(max(vocab.values())).bit_length()
        keys = (left << self.shift) | right
        self.order = np.argsort(keys, kind="stable")
        self.keys, self.left, self.right, self.made = keys[self.order], left, right, made
        self.spelling = [b""] * (1 + max([*vocab.values(), *self.special_ids.values()]))
        for token, i in vocab.items():
            self.spelling[i] = self._bytes(token)
        for token, i in self.special_ids.items():
            self.spelling[i] = self._bytes(token)
        self.forget()
        forgettable(self)

    def forget(self) -> None:
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}

    def _bytes(self, token: str) -> bytes:
        own = [self.of_symbol.get(c) for c in token]
        return token.encode("utf-8") if None in own else bytes(own)

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merge rank of each pair, -1 where the pair never merges."""
        key = (a << self.shift) | b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.order[at], -1)

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit) of each non-empty pre-token."""
        sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        symbol = self.byte_ids[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        n = len(symbol)
        stop = np.cumsum(sizes)
        following = np.arange(1, n + 1)
        following[stop - 1] = -1
        preceding = np.arange(-1, n - 1)
        preceding[stop - sizes] = -1
        alive = np.ones(n, dtype=bool)

        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def add(at: np.ndarray) -> None:
            rank = self._ranks(symbol[at], symbol[following[at]])
            at, rank = at[rank >= 0], rank[rank >= 0]
            if not len(at):
                return
            by = np.argsort(rank, kind="stable")
            at, rank = at[by], rank[by]
            cuts = np.flatnonzero(np.diff(rank)) + 1
            for r, part in zip(rank[np.concatenate(([0], cuts))].tolist(), np.split(at, cuts)):
                if r in index:
                    index[r].append(part)
                else:
                    index[r] = [part]
                    heappush(active, r)

        add(np.flatnonzero(following >= 0))
        heapify(active)
        while active:
            rank = heappop(active)
            lists = index.pop(rank)
            at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            a, b, new = self.left[rank], self.right[rank], self.made[rank]
            gone = following[at]
            live = alive[at] & (symbol[at] == a) & (gone >= 0)
            at, gone = at[live], gone[live]
            live = symbol[gone] == b
            at, gone = at[live], gone[live]
            if a == b and len(at) > 1:
                # runs of one symbol: take every other pair of a run, from the left
                first = np.concatenate(([True], at[1:] != gone[:-1]))
                run = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
                take = (np.arange(len(at)) - run) % 2 == 0
                at, gone = at[take], gone[take]
            if not len(at):
                continue
            symbol[at] = new
            alive[gone] = False
            after = following[gone]
            following[at] = after
            linked = after >= 0
            preceding[after[linked]] = at[linked]
            before = preceding[at]
            add(np.unique(np.concatenate((at[linked], before[before >= 0]))))

        ids = symbol[alive].astype("<u4")
        ends = np.cumsum(np.add.reduceat(alive, stop - sizes, dtype=np.int64)) * 4 if len(pieces) else []
        blob, out, start = ids.tobytes(), [], 0
        for end in ends:
            out.append(blob[start:end])
            start = end
        return out

    # -- whole texts -------------------------------------------------------

    def _segments(self, text: str) -> Iterator[tuple[str, int | None]]:
        for i, part in enumerate(self.special.split(text)):
            if part:
                yield part, self.special_ids[part] if i % 2 else None

    def _library_pieces(self, text: str) -> list[bytes]:
        split = library_tokenizer(self.path).pre_tokenizer.pre_tokenize_str(text)
        return [self._bytes(spelled) for spelled, _ in split]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text of a slice; pre-tokens met for the first time go
        through the pair index together, known ones come from the cache."""
        if len(self.pieces) > CACHE_ENTRIES or len(self.chunks) > CACHE_ENTRIES:
            self.forget()
        plans, chunks = [], self.chunks
        fresh: dict[str, list[str]] = {}
        wanted: dict[str | bytes, None] = {}
        for text in texts:
            plan = []
            for part, special in ([(text, None)] if "<|" not in text else self._segments(text)):
                if special is not None:
                    plan.append(special.to_bytes(4, "little"))
                elif is_plain(part):
                    own = BYTE_CHUNKS.findall(part)
                    for c in set(own).difference(chunks):
                        if c not in fresh:
                            fresh[c] = BYTE_PIECES.findall(c)
                            wanted.update(dict.fromkeys(fresh[c]))
                    plan.append(own)
                else:
                    own = tuple(self._library_pieces(part))
                    wanted.update(dict.fromkeys(own))
                    plan.append(own)
            plans.append(plan)
        pieces = self.pieces
        new = [p for p in wanted if p not in pieces]
        spelled = [p if isinstance(p, bytes) else p.encode("utf-8") for p in new]
        if new:
            pieces.update(zip(new, self.encode_pieces(spelled)))
        for c, parts in fresh.items():
            chunks[c] = b"".join(map(pieces.__getitem__, parts))
        return [b"".join(p if isinstance(p, bytes) else
                         b"".join(map((chunks if isinstance(p, list) else pieces).__getitem__, p)) for p in plan)
                for plan in plans]

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 text of the ids; bytes that are no text become the replacement character."""
        raw = b"".join(map(self.spelling.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))
        try:
            raw.decode("utf-8")
        except UnicodeDecodeError:
            raw = raw.decode("utf-8", errors="replace").encode("utf-8")
        return raw


@lru_cache(maxsize=2)
def codec(path: str) -> PairIndexBpe:
    return PairIndexBpe(path)


def encode_ids(text: Column, path: str) -> Column:
    """``array<int>`` of token ids of each text."""

    @pandas_udf("array<int>")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(path)
        for batch in batches:
            yield pd.Series([np.frombuffer(x, dtype="<i4") for part in slices(batch) for x in own.encode(part)],
                            dtype=object)

    return ids(text)


def decode_ids(ids: Column, path: str) -> Column:
    """Text of each array of ids (null: empty)."""

    @pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = codec(path)
        for batch in batches:
            yield pd.Series([own.decode(np.asarray([] if x is None else x, dtype="<u4").tobytes()).decode("utf-8")
                             for x in batch], dtype=object)

    return text(ids)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256: ids and decoded text are
    made and digested slice by slice, so neither crosses to the JVM."""

    @pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = codec(path)
        keep_only(own)
        for batch in batches:
            rows = []
            for part in slices(batch):
                rows += [(len(x) // 4, hashlib.sha256(x).hexdigest(), hashlib.sha256(own.decode(x)).hexdigest())
                         for x in own.encode(part)]
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    kept = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    done = kept.select("doc_id", digest("text").alias("done"))
    return done.select("doc_id", "done.n_tokens", "done.ids_sha256", "done.decoded_sha256")
