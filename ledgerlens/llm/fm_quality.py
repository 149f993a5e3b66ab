"""Quality classifier: a factorisation machine over hashed words, structure
statistics and the recorded length.

Words are hashed to ``BUCKETS`` counts of unit length; seventeen statistics of
the text follow as dense inputs.  Pairwise interactions are products of factor
vectors; the sum over all pairs is taken in linear time as half of the square
of the sum less the sum of the squares, factor by factor.  Fitted on a bounded
sample of labelled rows (``labelled.SAMPLE_DOCS``) outside the held-out fold;
every document is scored.

Defined cases: null and empty texts are scored from their statistics alone; a
null recorded length is the text's own; without labelled rows every score is
0.5 and ``keep_good`` keeps every document; repeated rows give repeated results;
an empty table gives no rows; a null doc_id is scored and never learnt from;
texts of any length are scored whole; other columns are not read, so their names
cannot clash.  The statistics were chosen by cross-validation inside the
learning fold (``choice``).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from ledgerlens.llm.labelled import held_out, training_sample
from ledgerlens.llm.textual import Cache, keep_only, slices

BUCKETS = 1 << 16
FACTORS = 8
STATS = 17
_RUNS = re.compile(r"[^\W_]+|[^\w\s]+|_+")

#: chunk -> the buckets of its runs of letters and of other characters, as 32-bit integers
_buckets = Cache(lambda chunk: np.array(
    [xxhash.xxh3_64_intdigest(run.encode("utf-8")) % BUCKETS for run in _RUNS.findall(chunk)], dtype="<i4").tobytes(),
                 150_000)

_UPPER, _LOWER, _DIGIT = (np.arange(lo, hi + 1) for lo, hi in ((65, 90), (97, 122), (48, 57)))
_SYMBOLS = np.frombuffer(b"#*$%&|<>~^=+@\\/_", dtype=np.uint8)


def _statistics(text: str, tokens: int, distinct: int, most: int, echoes: int, recorded: float) -> list[float]:
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    seen = np.bincount(raw, minlength=256)
    size, chars = max(1, len(raw)), max(1, len(text))
    lines = text.split("\n")
    words = max(1, tokens)
    upper, lower = seen[_UPPER].sum(), seen[_LOWER].sum()
    return [
        np.log1p(recorded) / 12, np.log1p(tokens) / 10, min(1.0, chars / words / 20),
        seen[_SYMBOLS].sum() / size * 4, seen[_DIGIT].sum() / size * 4, upper / max(1, upper + lower),
        seen[124] / words, seen[33] / words, (seen[32] + seen[10]) / size * 2, distinct / words,
        1 - len(set(lines)) / len(lines), np.log1p(len(lines)) / 8, np.log1p(words / len(lines)) / 8,
        (seen[46] + seen[44]) / words, seen[128:].sum() / size * 2,
        most / words, echoes / words,
    ]


@dataclass
class Inputs:
    """Sparse counts of unit length (one run of ``ids`` a row, in order) and dense statistics."""
    row: np.ndarray
    ids: np.ndarray
    values: np.ndarray
    dense: np.ndarray


def inputs_of(texts: list[str], recorded: list[float]) -> Inputs:
    blobs = [b"".join(map(_buckets.__getitem__, t.lower().split())) for t in texts]
    sizes = np.array([len(b) // 4 for b in blobs], dtype=np.int64)
    flat = np.frombuffer(b"".join(blobs), dtype="<i4").astype(np.int64)
    placed = np.repeat(np.arange(len(texts)), sizes) * BUCKETS + flat
    keys, counts = np.unique(placed, return_counts=True)
    row, ids = keys // BUCKETS, keys % BUCKETS
    norm = np.sqrt(np.bincount(row, weights=counts.astype(float) ** 2, minlength=len(texts)))
    distinct = np.bincount(row, minlength=len(texts))
    most = np.zeros(len(texts), dtype=np.int64)
    np.maximum.at(most, row, counts)
    # tokens like the one before
    echoes = np.bincount(placed[1:][placed[1:] == placed[:-1]] // BUCKETS, minlength=len(texts))
    dense = np.array([_statistics(t, *map(int, n), r) for t, n, r in zip(
        texts, zip(sizes, distinct, most, echoes), recorded)], dtype=np.float32).reshape(len(texts), STATS)
    return Inputs(row, ids, (counts / norm[row]).astype(np.float32), dense)


@dataclass
class Machine:
    bias: float
    linear: np.ndarray          # BUCKETS + STATS
    factors: np.ndarray         # the same, FACTORS wide

    def parts(self, x: Inputs) -> tuple[np.ndarray, np.ndarray]:
        """Logit and factor sums of each row."""
        n = len(x.dense)
        v = self.factors[x.ids] * x.values[:, None]
        # without any word the counts would be integers
        sums = np.stack([np.bincount(x.row, weights=v[:, f], minlength=n) for f in range(FACTORS)], axis=1).astype(float)
        squares = np.bincount(x.row, weights=(v * v).sum(axis=1), minlength=n).astype(float)
        own = self.factors[BUCKETS:]
        sums += x.dense @ own
        squares += (x.dense ** 2) @ (own ** 2).sum(axis=1)
        line = np.bincount(x.row, weights=self.linear[x.ids] * x.values, minlength=n) + x.dense @ self.linear[BUCKETS:]
        return self.bias + line + 0.5 * ((sums ** 2).sum(axis=1) - squares), sums

    def score(self, x: Inputs) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.parts(x)[0], -30, 30)))


def fit(x: Inputs, y: np.ndarray, epochs: int = 12, batch: int = 256, rate: float = 0.1, decay: float = 1e-5,
        seed: int = 7) -> Machine:
    """AdaGrad on the logistic loss; the same sample gives the same machine."""
    rng = np.random.default_rng(seed)
    size = BUCKETS + STATS
    m = Machine(0.0, np.zeros(size, dtype=np.float32), rng.normal(0, 0.05, (size, FACTORS)).astype(np.float32))
    if not len(y):
        m.factors[:] = 0
        return m
    seen_bias, seen_line = 1e-6, np.full(size, 1e-6, dtype=np.float32)
    seen_factors = np.full((size, FACTORS), 1e-6, dtype=np.float32)
    ends = np.searchsorted(x.row, np.arange(len(y) + 1))
    dense_at = np.arange(BUCKETS, size)
    for _ in range(epochs):
        mixed = rng.permutation(len(y))
        for start in range(0, len(y), batch):
            rows = np.sort(mixed[start:start + batch])
            take = np.concatenate([np.arange(ends[r], ends[r + 1]) for r in rows])
            row = np.repeat(np.arange(len(rows)), ends[rows + 1] - ends[rows])
            part = Inputs(row, x.ids[take], x.values[take], x.dense[rows])
            logit, sums = m.parts(part)
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[rows]) / len(rows)
            used, at = np.unique(part.ids, return_inverse=True)
            by_value = error[row] * part.values
            line = np.concatenate((np.bincount(at, weights=by_value, minlength=len(used)), error @ part.dense))
            square = np.concatenate((np.bincount(at, weights=by_value * part.values, minlength=len(used)),
                                     error @ (part.dense ** 2)))
            cross = np.stack([np.concatenate((np.bincount(at, weights=by_value * sums[row, f], minlength=len(used)),
                                              (error * sums[:, f]) @ part.dense)) for f in range(FACTORS)], axis=1)
            where = np.concatenate((used, dense_at))
            line = line + decay * m.linear[where]
            cross = cross - square[:, None] * m.factors[where] + decay * m.factors[where]
            seen_line[where] += line ** 2
            seen_factors[where] += cross ** 2
            m.linear[where] -= rate * line / np.sqrt(seen_line[where])
            m.factors[where] -= rate * 0.3 * cross / np.sqrt(seen_factors[where])
            seen_bias += error.sum() ** 2
            m.bias -= rate * error.sum() / seen_bias ** 0.5
    return m


def _known(texts: list[str], recorded: list[float | None]) -> list[float]:
    """The recorded lengths, a null one being the text's own."""
    return [float(len(t) if n is None or n != n else max(0, n)) for t, n in zip(texts, recorded)]


def train(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Machine:
    rows = training_sample(docs, labels, label, recorded=recorded_length(docs))

    @pandas_udf("ids binary, values binary, dense binary")
    def features(text: pd.Series, recorded: pd.Series) -> pd.DataFrame:
        lengths, out = recorded.tolist(), []
        for part in slices(text):
            x = inputs_of(part, _known(part, lengths[len(out):len(out) + len(part)]))
            cut = np.searchsorted(x.row, np.arange(len(part) + 1))
            out += [(x.ids[a:b].astype("<i4").tobytes(), x.values[a:b].tobytes(), x.dense[i].tobytes())
                    for i, (a, b) in enumerate(zip(cut, cut[1:]))]
        return pd.DataFrame(out, columns=["ids", "values", "dense"])

    got = sorted(rows.select("doc_id", "y", features("text", "recorded").alias("x")).collect(), key=lambda r: r.doc_id)
    if not got:
        empty = np.zeros(0)
        return fit(Inputs(empty, empty, empty, np.zeros((0, STATS))), empty)
    sizes = [len(r.x.ids) // 4 for r in got]
    x = Inputs(np.repeat(np.arange(len(got)), sizes),
               np.frombuffer(b"".join(bytes(r.x.ids) for r in got), dtype="<i4").astype(np.int64),
               np.frombuffer(b"".join(bytes(r.x["values"]) for r in got), dtype=np.float32),
               np.frombuffer(b"".join(bytes(r.x.dense) for r in got), dtype=np.float32).reshape(len(got), STATS))
    return fit(x, np.array([float(r.y > 0) for r in got]))


def quality_score(text: Column, n_chars: Column, machine: Machine) -> Column:
    """Score of each text, 0 to 1; ``n_chars`` is the recorded length."""

    @pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        keep_only(_buckets)
        for texts, recorded in batches:
            lengths, out, at = recorded.tolist(), [], 0
            for part in slices(texts):
                out.append(machine.score(inputs_of(part, _known(part, lengths[at:at + len(part)]))))
                at += len(part)
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))

    return score(text, n_chars.cast("double"))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    scored = docs.select("doc_id", quality_score(F.col("text"), recorded_length(docs), train(docs, labels))
                         .alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def recorded_length(docs: DataFrame) -> Column:
    return F.col("n_chars") if "n_chars" in docs.columns else F.length("text")


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``docs`` without the documents that score under the threshold; all of them without any labelled row."""
    machine = train(docs, labels)
    # fitted on nothing, it tells nothing
    if not machine.factors.any():
        return docs
    score = quality_score(F.col("text"), recorded_length(docs), machine)
    return docs.where(score >= threshold)
