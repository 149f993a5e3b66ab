"""Token counts: exact BPE token count of every prefix by dynamic programming.

For one pre-token, the encoding of a prefix ends with the only vocabulary
token whose left neighbour (the last token of the shorter prefix) is stable
next to it: merging the two spellings from scratch gives the two tokens back.
The table of last tokens therefore grows by one entry a byte, and the token
count of each prefix is one more than that of the prefix before its last
token.  The end-of-word form of a prefix comes from the same table.  Counts of
whole texts are sums over pre-tokens, so any truncation or budget question is
answered from the table without encoding again.

Defined cases: a null text counts as empty; an empty text has no tokens and
the prefix table ``[0]``; special strings count as one token where they are
complete and as ordinary text in a prefix that ends inside them; positions are
code points of the text after the tokenizer's normalisation (the same as the
raw ones unless NFC or lower-casing changes the length).  Repeated rows give
repeated results; an empty table gives no rows; texts of any length are counted
whole; a null doc_id is kept; only doc_id and text are read, so names of other
columns cannot clash.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, islice

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from ledgerlens.llm.textual import (WORD_PIECES, Cache, byte_symbols, is_plain, library_tokenizer, slices,
                                    special_pattern, tokenizer_spec)

_CHUNK = re.compile(r"\S+")
#: Prefixes up to this many symbols are kept in the shared table.
SHARED_PREFIX = 64


class PrefixCounter:
    """Prefix tables of one word-level BPE vocabulary (end-of-word suffix)."""

    def __init__(self, path: str):
        spec = tokenizer_spec(path)
        self.path, self.model = path, spec["model"]
        self.vocab = self.model["vocab"]
        self.suffix = self.model["end_of_word_suffix"] or ""
        self.ranks = {tuple(m): r for r, m in enumerate(self.model["merges"])}
        self.longest = max(map(len, self.vocab))
        self.symbols = byte_symbols()
        self.special = special_pattern(path)
        self.stable = Cache(self._stable, 400_000)
        self.whole = Cache(lambda t: self.merge(t) == [t], 100_000)
        self.last = Cache(self._last_of)
        self.piece_total = Cache(lambda p: self.total(self.spell(p)))
        self.chunk_total = Cache(lambda c: sum(map(self.piece_total.__getitem__, WORD_PIECES.findall(c))))

    def spell(self, piece: str) -> str:
        return "".join(self.symbols[b] for b in piece.encode("utf-8")) if not piece.isascii() else piece

    def merge(self, spelled: str) -> list[str]:
        """Plain rank-ordered merging; only short strings come here, once each."""
        closed = bool(self.suffix) and spelled.endswith(self.suffix)
        body = spelled.removesuffix(self.suffix) if closed else spelled
        parts = list(body)
        if closed:
            parts[-1] += self.suffix
        while len(parts) > 1:
            best = min(zip(parts, parts[1:]), key=lambda p: self.ranks.get(p, 1 << 40))
            if best not in self.ranks:
                break
            out, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == best:
                    out.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def _stable(self, pair: tuple[str, str]) -> bool:
        return self.merge(pair[0] + pair[1]) == [*pair]

    def _last_of(self, prefix: str) -> tuple[str, int]:
        """Last token and token count of a prefix; shorter prefixes come from the same table."""
        vocab, stable, last = self.vocab, self.stable, self.last
        if prefix in vocab and self.whole[prefix]:
            return prefix, 1
        for start in range(max(1, len(prefix) - self.longest), len(prefix)):
            token = prefix[start:]
            if token in vocab:
                before, n = last[prefix[:start]]
                if stable[before, token]:
                    return token, n + 1
        raise ValueError(f"the vocabulary does not spell {prefix!r}")

    def _close(self, spelled: str, end: int, table) -> int:
        """Tokens of ``spelled[:end]`` as a whole word; ``table(k)`` is the entry of the open prefix of k."""
        vocab, stable = self.vocab, self.stable
        for start in range(max(0, end - self.longest), end):
            token = spelled[start:end] + self.suffix
            if token in vocab:
                before, n = table(start)
                if stable[before, token] if start else self.whole[token]:
                    return n + 1
        raise ValueError(f"the vocabulary does not spell {spelled!r}")

    def total(self, spelled: str) -> int:
        """Tokens of a whole pre-token.  Short ones share the table of all prefixes met so far."""
        if len(spelled) > SHARED_PREFIX:
            return self.closed(spelled)[-1]
        return self._close(spelled, len(spelled), lambda k: self.last[spelled[:k]] if k else ("", 0))

    def closed(self, spelled: str) -> list[int]:
        """Tokens of every prefix (0, 1, ... symbols) of a pre-token, each as a word of its own."""
        own, vocab, stable = [("", 0)], self.vocab, self.stable
        out = [0]
        for end in range(1, len(spelled) + 1):
            for start in range(max(0, end - self.longest), end):
                token = spelled[start:end]
                if token in vocab and (stable[own[start][0], token] if start else self.whole[token]):
                    own.append((token, own[start][1] + 1))
                    break
            else:
                raise ValueError(f"the vocabulary does not spell {spelled!r}")
            out.append(self._close(spelled, end, own.__getitem__))
        return out

    # -- whole texts -------------------------------------------------------

    def _segment(self, text: str) -> int:
        if is_plain(text):
            return sum(map(self.chunk_total.__getitem__, text.lower().split()))
        return sum(self.total(s) for s, _ in self._spelled(text)[1])

    def count(self, text: str) -> int:
        if "<|" not in text:
            return self._segment(text)
        return sum(1 if i % 2 else self._segment(part) for i, part in enumerate(self.special.split(text)) if part)

    def _spelled(self, text: str) -> tuple[str, list[tuple[str, tuple[int, int]]]]:
        """The normalised segment, and its pre-tokens as spelled with their spans."""
        if is_plain(text):
            low = text.lower()
            low = low.replace("\r", " ").replace("\n", " ").replace("\t", " ")
            return low, [(self.spell(m[0]), m.span()) for m in WORD_PIECES.finditer(low)]
        tok = library_tokenizer(self.path)
        norm = tok.normalizer.normalize_str(text)
        return norm, tok.pre_tokenizer.pre_tokenize_str(norm)

    def _inside(self, norm: str, span: tuple[int, int], spelled: str) -> list[int]:
        """Tokens of the pre-token's prefixes of 0, 1, ... code points."""
        piece = norm[span[0]:span[1]]
        table = self.closed(spelled)
        if piece in ("'re", "'ve", "'ll"):
            # a contraction cut after one letter is an apostrophe and a letter
            return [0, table[1], table[1] + self.piece_total[piece[1]], table[3]]
        ends = accumulate(len(c.encode("utf-8")) for c in piece)
        return [0, *(table[e] for e in ends)]

    def table(self, text: str) -> list[int]:
        """Tokens of the prefixes of 0, 1, 2, ... code points."""
        out, before = [0], 0
        for i, part in enumerate(self.special.split(text)):
            if i % 2:
                # the text before it in this segment is part of what an unfinished special string joins
                earlier = self._segment(previous)
                out += [before - earlier + self._segment(previous + part[:k]) for k in range(1, len(part))]
                before += 1
                out.append(before)
                continue
            previous = part
            if not part:
                continue
            norm, pieces = self._spelled(part)
            at = 0
            for spelled, (start, end) in pieces:
                out += [before] * (start - at)
                inside = self._inside(norm, (start, end), spelled)
                out += [before + n for n in inside[1:]]
                before += inside[-1]
                at = end
            out += [before] * (len(norm) - at)
        return out

    def cut(self, text: str, budget: int) -> int:
        """Code points of the longest prefix with at most ``budget`` tokens.

        Only the pre-token in which the budget ends has its table built; texts
        with special strings or unusual characters read their whole table.
        """
        if not is_plain(text) or self.special.search(text):
            table = self.table(text)
            return max(i for i, n in enumerate(table) if n <= budget)
        low = text.lower()
        ends = list(accumulate(map(self.chunk_total.__getitem__, low.split())))
        full = bisect_right(ends, budget)  # chunks that fit whole
        if full == len(ends):
            return len(text)
        before = ends[full - 1] if full else 0
        at = next(islice(_CHUNK.finditer(low), full, None)).start()
        for m in WORD_PIECES.finditer(low, at):
            n = self.piece_total[m[0]]
            if before + n > budget:
                inside = self._inside(low, m.span(), self.spell(m[0]))
                return m.start() + max(k for k, x in enumerate(inside) if before + x <= budget)
            before += n
        return len(text)


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_budget(text: Column, path: str, budget: int = 2048) -> Column:
    """Struct of ``n_tokens`` and ``cut_chars``: the code points of the longest
    prefix within ``budget`` tokens, read off the prefix tables."""

    @pandas_udf("n_tokens long, cut_chars long")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = counter(path)
        for batch in batches:
            rows = []
            for part in slices(batch):
                for t in part:
                    n = own.count(t)
                    rows.append((n, len(t) if n <= budget else own.cut(t, budget)))
            yield pd.DataFrame(rows, columns=["n_tokens", "cut_chars"], dtype="int64")

    return ask(text)


def prefix_table(text: Column, path: str) -> Column:
    """Token counts of every prefix (0, 1, 2, ... code points) as ``array<int>``;
    ``element_at(table, k + 1)`` is the count of the first ``k`` code points."""

    @pandas_udf("array<int>")
    def tables(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = counter(path)
        for batch in batches:
            yield pd.Series([own.table(t or "") for t in batch], dtype=object)

    return tables(text)


def token_counts(docs: DataFrame, path: str, limit: int = 2048, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and the longest prefix within the
    limit; one row per input row, repeated rows included."""
    kept = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    asked = kept.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                        token_budget(F.col("text"), path, limit).alias("asked"))
    return asked.select("doc_id", "n_bytes", F.col("asked.n_tokens").alias("n_tokens"),
                        (F.col("asked.n_tokens") > limit).alias("over_limit"),
                        F.col("asked.cut_chars").alias("cut_chars"))
