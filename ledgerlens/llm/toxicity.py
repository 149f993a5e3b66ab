"""Toxicity: a counterfactual-regularised linear classifier.

A text's inputs are the presence of its words and of their beginnings of
four and five letters.  The classifier is a sparse logistic regression on a
bounded sample of labelled rows.  For every sampled sentence that mentions an
identity term the term is swapped for the others of its group; the squared
difference of the two logits is added to the loss, so a mention of a group
cannot carry the verdict by itself.  Inputs that never leave zero weight are
dropped, and each distinct word is looked up once a worker.

Defined cases: null, empty and wordless texts get the score of a text without
any weighted input; without labelled rows every score is 0.5; repeated rows
give repeated results; an empty table gives no rows; texts of any length are
scored whole; a null doc_id is scored and never learnt from; other columns are
not read, so their names cannot clash.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from ledgerlens.llm.labelled import held_out, training_sample
from ledgerlens.llm.native import written
from ledgerlens.llm.textual import Cache, slices

#: Identity terms; the terms of one line are swapped for one another.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("female", "male", "transgender"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "queer"),
    ("immigrants", "refugees", "citizens", "foreigners"),
    ("disabled", "deaf", "blind", "autistic"),
    ("old", "young", "elderly", "teenage"),
)
_GROUP = {term: group for group in IDENTITY_TERMS for term in group}
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")
#: Lengths of the word beginnings that are inputs.
STEMS = (4, 5)
#: Soft threshold, times sqrt(ln inputs / documents): rarer evidence needs more of it in a smaller sample.
SPARSE = 0.02
#: Inputs seen in fewer sampled documents than this are not learnt.
LEAST_DOCS = 3


def _keys(word: str) -> list[int]:
    """The word and, where it is longer, its beginnings, as 64-bit hashes."""
    parts = {f"w{word}", *(f"{n}{word[:n]}" for n in STEMS if len(word) >= n)}
    return [xxhash.xxh3_64_intdigest(p.encode("utf-8")) for p in parts]


_word_keys = Cache(lambda w: np.array(_keys(w), dtype=np.uint64).tobytes())
_chunk_words = Cache(lambda c: tuple(_WORD.findall(c)))


def _words(text: str) -> set[str]:
    found: set[str] = set()
    for chunk in set(text.lower().split()):
        found.update(_chunk_words[chunk])
    return found


def keys_of(text: str) -> np.ndarray:
    """Distinct input keys of a text."""
    return np.unique(np.frombuffer(b"".join(map(_word_keys.__getitem__, _words(text))), dtype=np.uint64))


def swaps(text: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Input keys of each sentence that names an identity term, and of the sentence with the term swapped."""
    out = []
    for sentence in _SENTENCE.findall(text.lower()):
        words = set(_WORD.findall(sentence))
        for term in words & _GROUP.keys():
            own = keys_of(sentence)
            for other in _GROUP[term]:
                if other != term:
                    out.append((own, keys_of(" ".join(words - {term} | {other}))))
    return out


@dataclass
class Linear:
    bias: float = 0.0
    keys: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint64))  # ascending
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.float64))

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, those unknown left out."""
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        return at[self.keys[at] == keys] if len(self.keys) else at[:0]

    def logit(self, keys: np.ndarray) -> float:
        return self.bias + float(self.weights[self.of(keys)].sum())


def fit(rows: list[np.ndarray], y: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]],
        times: list[int] | None = None, fairness: float = 1.0, epochs: int = 15, batch: int = 128, rate: float = 0.1, seed: int = 7) -> Linear:
    """AdaGrad on the logistic loss plus ``fairness`` times the mean squared logit
    change over the swapped pairs, each counted ``times`` (once if not given),
    with soft thresholding (``SPARSE``)."""
    if not len(rows):
        return Linear()
    every, docs = np.unique(np.concatenate(rows), return_counts=True)
    # what swaps bring in is learnt too, whatever its frequency
    named = [k for a, b in pairs for k in np.setxor1d(a, b).tolist()]
    keys = np.union1d(every[docs >= min(LEAST_DOCS, len(rows))], np.array(named, dtype=np.uint64))
    m = Linear(0.0, keys, np.zeros(len(keys)))
    sparse = SPARSE * np.sqrt(np.log(2 + len(keys)) / len(rows))
    at = [m.of(r) for r in rows]
    change = [(m.of(np.setdiff1d(a, b)), m.of(np.setdiff1d(b, a))) for a, b in pairs]
    rng, seen, seen_bias = np.random.default_rng(seed), np.full(len(keys), 1e-6), 1e-6
    upto = np.cumsum(np.ones(len(change), dtype=np.int64) if times is None else np.array(times, dtype=np.int64))
    total = int(upto[-1]) if len(upto) else 0
    share = total / max(1, len(rows))
    for _ in range(epochs):
        mixed = rng.permutation(len(rows))
        for start in range(0, len(rows), batch):
            part = mixed[start:start + batch]
            flat = np.concatenate([at[i] for i in part])
            row = np.repeat(np.arange(len(part)), [len(at[i]) for i in part])
            logit = m.bias + np.bincount(row, weights=m.weights[flat], minlength=len(part))
            error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[part]) / len(part)
            used, where = np.unique(flat, return_inverse=True)
            step = np.bincount(where, weights=error[row], minlength=len(used))
            _move(m.weights, seen, used, step, rate, sparse)
            seen_bias += error.sum() ** 2
            m.bias -= rate * error.sum() / seen_bias ** 0.5
            if change:
                slope: Counter = Counter()
                drawn = rng.integers(0, total, size=max(1, round(len(part) * min(1.0, share))))
                chosen = np.searchsorted(upto, drawn, side="right")
                for i in chosen:
                    gone, come = change[i]
                    gap = 2 * fairness * (m.weights[gone].sum() - m.weights[come].sum()) / len(chosen)
                    for k in gone.tolist():
                        slope[k] += gap
                    for k in come.tolist():
                        slope[k] -= gap
                if slope:
                    _move(m.weights, seen, np.array(list(slope)), np.array(list(slope.values())), rate, 0.0)
    kept = m.weights != 0
    return Linear(m.bias, m.keys[kept], m.weights[kept])


def _move(weights: np.ndarray, seen: np.ndarray, at: np.ndarray, step: np.ndarray, rate: float, sparse: float) -> None:
    seen[at] += step ** 2
    scale = rate / np.sqrt(seen[at])
    new = weights[at] - scale * step
    weights[at] = np.sign(new) * np.maximum(0.0, np.abs(new) - scale * sparse)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Linear:
    """Only the input keys of a sample bounded in rows and bytes reach the
    driver, and of its swaps each distinct difference with its number."""
    @pandas_udf("own binary, swaps array<struct<gone: binary, come: binary>>")
    def features(text: pd.Series) -> pd.DataFrame:
        out = []
        for part in slices(text):
            for t in part:
                out.append((keys_of(t).tobytes(), [{"gone": np.setdiff1d(a, b).tobytes(), "come": np.setdiff1d(b, a).tobytes()}
                                                   for a, b in swaps(t)]))
        return pd.DataFrame(out, columns=["own", "swaps"])

    read = written(training_sample(docs, labels, label).select("doc_id", "y", features("text").alias("x")).select(
        "doc_id", "y", "x.own", "x.swaps"), "toxicity-sample")
    got = sorted(read.select("doc_id", "y", "own").collect(), key=lambda r: r.doc_id)
    # identity terms and their beginnings: the same few differences however many sentences
    swapped = read.select(F.explode("swaps").alias("s")).groupBy("s.gone", "s.come").count().collect()
    told = sorted((bytes(r.gone), bytes(r.come), r["count"]) for r in swapped)
    keys = [np.frombuffer(bytes(r.own), dtype=np.uint64) for r in got]
    pairs = [(np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)) for a, b, _ in told]
    return fit(keys, np.array([float(r.y > 0) for r in got]), pairs, [n for *_, n in told])


def toxicity_score(text: Column, model: Linear) -> Column:
    @pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        # word -> the places of its weighted inputs; most words have none
        place = {k: i for i, k in enumerate(model.keys.tolist())}
        known = Cache(lambda w: tuple(place[k] for k in _keys(w) if k in place))
        chunk = Cache(lambda c: tuple(p for w in _chunk_words[c] for p in known[w]))
        for batch in batches:
            out = []
            for part in slices(batch):
                for t in part:
                    places = {p for c in set(t.lower().split()) for p in chunk[c]}
                    z = model.bias + sum(model.weights[sorted(places)].tolist())
                    out.append(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))))
            yield pd.Series(out, dtype="float64")

    return score(text)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    scored = docs.select("doc_id", toxicity_score(F.col("text"), train(docs, labels)).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
