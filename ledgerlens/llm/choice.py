"""Choosing the settings of the trained classifiers inside the learning fold.

Labelled rows outside the held-out fold are dealt into ``FOLDS`` parts by a
hash of their id; each part is scored by a machine fitted on the others.  The
settings of the classifiers are those of the least mean logistic loss; the
held-out fold is never read here.  ``python -m ledgerlens.llm.choice SF_DIR``
prints the losses of the settings that were compared.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from multiprocessing import Pool

import numpy as np

from ledgerlens.llm import fm_quality as fm, toxicity as tox

FOLDS = 4


def learning_rows(doc_ids: list[int], y: list[int | None]) -> list[int]:
    """Places of the rows that may be learnt from: labelled and not held out."""
    return [k for k, (i, v) in enumerate(zip(doc_ids, y)) if v is not None and i is not None
            and zlib.crc32(str(i).encode()) % 4 != 2]


def fold_of(doc_id: int) -> int:
    return zlib.crc32(f"fold {doc_id}".encode()) % FOLDS


def mean_loss(doc_ids: list[int], y: np.ndarray, fit: Callable[[np.ndarray], Callable[[np.ndarray], np.ndarray]]) -> float:
    """Logistic loss over all rows, each scored without its fold.  ``fit`` takes
    the places to learn from and returns a function from places to scores."""
    folds, scores = np.array([fold_of(i) for i in doc_ids]), np.zeros(len(y))
    for k in range(FOLDS):
        scores[folds == k] = fit(np.flatnonzero(folds != k))(np.flatnonzero(folds == k))
    p = np.clip(scores, 1e-6, 1 - 1e-6)
    return float(-np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)))


@contextmanager
def _settings(module, **values) -> Iterator[None]:
    before = {name: getattr(module, name) for name in values}
    try:
        for name, value in values.items():
            setattr(module, name, value)
        tox._word_keys.forget()
        yield
    finally:
        for name, value in before.items():
            setattr(module, name, value)
        tox._word_keys.forget()


def toxicity_loss(doc_ids: list[int], texts: list[str], y: np.ndarray, stems: tuple[int, ...], sparse: float) -> float:
    with _settings(tox, STEMS=stems, SPARSE=sparse):
        keys, pairs = [tox.keys_of(t) for t in texts], [tox.swaps(t) for t in texts]

        def fit(rows: np.ndarray):
            m = tox.fit([keys[i] for i in rows], y[rows], [p for i in rows for p in pairs[i]])
            return lambda other: 1 / (1 + np.exp(-np.array([m.logit(keys[i]) for i in other])))

        return mean_loss(doc_ids, y, fit)


def quality_loss(doc_ids: list[int], texts: list[str], lengths: list[float], y: np.ndarray, left_out: tuple[int, ...]) -> float:
    """``left_out``: statistics that are held at zero."""
    def inputs(rows: np.ndarray) -> fm.Inputs:
        x = fm.inputs_of([texts[i] for i in rows], [lengths[i] for i in rows])
        x.dense[:, list(left_out)] = 0
        return x

    def fit(rows: np.ndarray):
        m = fm.fit(inputs(rows), y[rows])
        return lambda other: m.score(inputs(other))

    return mean_loss(doc_ids, y, fit)


def _one(job: tuple) -> tuple[str, float]:
    name, function, *arguments = job
    return name, function(*arguments)


def main(sf_dir: str) -> None:
    from ledgerlens.llm.queries import table
    from ledgerlens.session import build_session
    spark = build_session("local[4]", app="choice")
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    rows = docs.join(labels, "doc_id").select("doc_id", "text", "n_chars", "quality", "toxic").orderBy("doc_id").collect()
    spark.stop()
    jobs = []
    for label in ("toxic", "quality"):
        places = learning_rows([r.doc_id for r in rows], [r[label] for r in rows])
        own = [rows[k] for k in places]
        ids, texts = [r.doc_id for r in own], [r.text or "" for r in own]
        y = np.array([float(r[label] > 0) for r in own])
        if label == "toxic":
            jobs += [(f"toxicity, beginnings {stems}, sparsity {sparse}", toxicity_loss, ids, texts, y, stems, sparse)
                     for stems in ((), (4,), (5,), (4, 5), (3, 4)) for sparse in (0.005, 0.02, 0.08)]
        else:
            lengths = [float(r.n_chars if r.n_chars is not None else len(r.text or "")) for r in own]
            jobs += [(f"quality, without statistics {out}", quality_loss, ids, texts, lengths, y, out)
                     for out in ((), (15,), (16,), (15, 16))]
    with Pool(8) as pool:
        for name, loss in sorted(pool.imap_unordered(_one, jobs), key=lambda x: (x[0].split(",")[0], x[1])):
            print(f"{loss:.4f}  {name}")


if __name__ == "__main__":
    main(sys.argv[1])
