"""Classifiers, near-duplicate classes and the pipeline."""

import collections
import random
import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as se
import corpus_pipeline
from ledgerlens.llm import fm_quality as fm, order_minhash as omh, toxicity as tox
from ledgerlens.llm.labelled import training_sample

from .conftest import EDGE_ROWS, SF


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


# -- factorisation machine -------------------------------------------------

def test_pairwise_sum_is_that_of_all_pairs():
    rng = np.random.default_rng(1)
    texts, m = ["one two two three ###", ""], fm.Machine(0.3, rng.normal(size=fm.BUCKETS + fm.STATS),
                                                          rng.normal(size=(fm.BUCKETS + fm.STATS, fm.FACTORS)))
    x = fm.inputs_of(texts, [float(len(t)) for t in texts])
    for r, got in enumerate(m.parts(x)[0]):
        own = {int(i): float(v) for i, v in zip(x.ids[x.row == r], x.values[x.row == r])}
        own |= {fm.BUCKETS + k: float(v) for k, v in enumerate(x.dense[r])}
        want = 0.3 + sum(m.linear[i] * v for i, v in own.items())
        want += sum(m.factors[i] @ m.factors[j] * own[i] * own[j] for i in own for j in own if i < j)
        assert got == pytest.approx(want, abs=1e-4)


@pytest.mark.parametrize("query, label, least", [("op1_quality_fm", "quality", 0.95), ("op10_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, query, label, least):
    sf = "/root/testdata/sf0.1"
    rows = se.queries()[query](spark, sf).collect()
    known = {r.doc_id: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= (0.7 if label == "quality" else 0.3)) for r in rows)
    test = [(known[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in known]
    rare = 0 if label == "quality" else 1
    assert np.mean([y == p for y, p in test]) >= 0.97
    assert np.mean([p == rare for y, p in test if y == rare]) >= least - 0.1
    assert np.mean([p != rare for y, p in test if y != rare]) >= 0.99


def test_training_sample(spark, edge, labels):
    got = {r.doc_id: (r.y, r.text) for r in training_sample(edge, labels, "quality").collect()}
    assert set(got) == {i for i in (1, 2, 3, 4, 5) if not held(i)}
    assert 4 not in got or got[4][0] == 0
    assert training_sample(edge, labels.limit(0), "quality").collect() == []


@pytest.mark.parametrize("score", [fm.quality, tox.toxicity])
def test_scores_of_edge_rows(score, edge, empty, clashing, labels):
    for df in (edge, clashing):
        rows = score(df, labels).collect()
        assert collections.Counter(r.doc_id for r in rows) == collections.Counter(i for i, *_ in EDGE_ROWS)
        assert all(0 <= r.score <= 1 and r.held_out == held(r.doc_id) for r in rows)
        assert score is tox.toxicity or len({r.score for r in rows if r.doc_id == 5}) == 2
    assert score(empty, labels).collect() == []
    assert {r.score for r in score(edge, labels.limit(0)).collect()} == {0.5}


def test_fitted_on_the_recorded_length(spark):
    """Equal texts whose labels follow n_chars alone."""
    ids = [i for i in range(400) if not held(i)]
    df = spark.createDataFrame([(i, "the same text", 5 if i % 2 else 90_000) for i in ids],
                               "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    scores = {r.doc_id: r.score for r in fm.quality(df, labels).collect()}
    assert min(s for i, s in scores.items() if i % 2) > max(s for i, s in scores.items() if not i % 2) + 0.2


def test_keep_good_without_labels_keeps_all(edge, labels):
    assert fm.keep_good(edge, labels.limit(0)).count() == len(EDGE_ROWS)


# -- toxicity --------------------------------------------------------------

def test_swaps():
    (a, b), = [p for p in tox.swaps("All deaf people sing. Nothing else.") if len(p[0])][:1]
    assert set(tox.keys_of("all deaf people sing").tolist()) == set(a.tolist()) != set(b.tolist())
    assert tox.swaps("no group is named") == []


def test_penalty_evens_out_identity_terms():
    rng = random.Random(3)
    filler = [f"plain{i}" for i in range(40)]
    texts, y = [], []
    for k in range(400):
        bad = k % 4 == 0
        ws = rng.sample(filler, 6) + (["vile"] if bad else []) + (["muslims"] if bad and k % 8 == 0 else [])
        texts.append(" ".join(ws) + ".")
        y.append(float(bad))
    rows, pairs = [tox.keys_of(t) for t in texts], [p for t in texts for p in tox.swaps(t)]
    gap = {}
    for weight in (0.0, 5.0):
        m = tox.fit(rows, np.array(y), pairs, fairness=weight)
        gap[weight] = abs(m.logit(tox.keys_of("the muslims sing")) - m.logit(tox.keys_of("the buddhists sing")))
        assert m.logit(tox.keys_of("plain1 vile plain2")) > m.logit(tox.keys_of("plain1 plain2")) + 1
    assert gap[5.0] < 0.2 * gap[0.0]


def test_scores_of_a_table_by_brute_force(spark, texts):
    """Every document's score from the weights, input by input and pair by pair."""
    import xxhash
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r.score for r in se.queries()["op10_toxicity"](spark, SF).collect()}
    m = tox.train(docs, labels)
    weight = dict(zip(m.keys.tolist(), m.weights.tolist()))
    for i, t in texts.items():
        words = set(re.findall(r"[^\W\d_]+", (t or "").lower()))
        inputs = {f"w{w}" for w in words} | {f"{n}{w[:n]}" for w in words for n in tox.STEMS if len(w) >= n}
        z = m.bias + sum(weight.get(xxhash.xxh3_64_intdigest(x.encode()), 0.0) for x in inputs)
        assert got[i] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-9)
    assert set(got) == set(texts)

    got = {r.doc_id: r.score for r in se.queries()["op1_quality_fm"](spark, SF).collect()}
    lengths = {r.doc_id: r.n_chars for r in docs.collect()}
    machine = fm.train(docs, labels)
    for i, t in texts.items():
        x = fm.inputs_of([t or ""], [float(lengths[i])])
        counts = collections.Counter(xxhash.xxh3_64_intdigest(r.encode()) % fm.BUCKETS for c in (t or "").lower().split()
                                     for r in re.findall(r"[^\W_]+|[^\w\s]+|_+", c))
        norm = np.sqrt(sum(n * n for n in counts.values())) or 1.0
        values = [*(n / norm for n in counts.values()), *x.dense[0].tolist()]
        places = [*counts, *range(fm.BUCKETS, fm.BUCKETS + fm.STATS)]
        v = machine.factors[places].astype(float) * np.array(values)[:, None]
        every = v @ v.T
        z = machine.bias + float(machine.linear[places] @ np.array(values)) + (every.sum() - np.trace(every)) / 2
        assert got[i] == pytest.approx(1 / (1 + np.exp(-np.clip(z, -30, 30))), abs=2e-4)


def test_settings_are_chosen_without_the_held_out_fold():
    from ledgerlens.llm import choice
    ids = list(range(300))
    y = [None if i % 7 == 0 else i % 2 for i in ids]
    places = choice.learning_rows(ids, y)
    assert places and not any(held(ids[k]) or y[k] is None for k in places)
    seen = []

    def fit(rows):
        def score(other):
            assert not set(rows.tolist()) & set(other.tolist())
            seen.extend(other.tolist())
            return np.full(len(other), 0.5)
        return score
    loss = choice.mean_loss([ids[k] for k in places], np.array([float(y[k]) for k in places]), fit)
    assert loss == pytest.approx(np.log(2)) and sorted(seen) == list(range(len(places)))
    texts = ["good words here", "vile words here"] * 20
    before = tox.STEMS, tox.SPARSE
    assert choice.toxicity_loss(list(range(40)), texts, np.array([0.0, 1.0] * 20), (4,), 0.0) < 0.5
    assert (tox.STEMS, tox.SPARSE) == before


def test_training_sample_is_bounded_in_bytes(spark):
    docs = spark.createDataFrame([(i, "w" * 1_000) for i in range(400)], "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2, 0) for i in range(400)], "doc_id long, quality int, toxic int")
    whole = training_sample(docs, marks, "quality").count()
    some = training_sample(docs, marks, "quality", limit=100_000)
    assert whole == sum(not held(i) for i in range(400)) and 50 < some.count() < 160


# -- Order MinHash ---------------------------------------------------------

def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        above = row[:]
        for j, y in enumerate(b):
            row[j + 1] = above[j] + 1 if x == y else max(above[j + 1], row[j])
    return row[-1]


def test_similarity_is_that_of_the_whole_alignment():
    rng = random.Random(11)
    for _ in range(300):
        a = [rng.randrange(30) for _ in range(rng.randrange(0, 40))]
        b = [x for x in a if rng.random() > 0.06]
        for _ in range(rng.randrange(3)):
            b.insert(rng.randrange(len(b) + 1), rng.randrange(30))
        common = lcs(a, b)
        whole = common / (len(a) + len(b) - common) if a or b else 1.0
        got = omh.similarity(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64))
        assert got == pytest.approx(whole if whole >= 0.8 else 0.0), (a, b)


def test_sketches_follow_order_and_occurrence():
    words = [f"w{i}" for i in range(60)]
    s = omh.shingles_of(words)
    assert (omh.sketches_of(s) == omh.sketches_of(s.copy())).all()
    assert (omh.sketches_of(s) == omh.sketches_of(s[::-1])).mean() < 0.3
    twice = np.concatenate((s, s))
    assert len(omh.sketches_of(twice)) == omh.SKETCHES and len(omh.sketches_of(s[:2])) == omh.SKETCHES


def brute_classes(texts):
    """Classes over all pairs that share one of their rarest shingles."""
    shingles = {}
    for i, t in texts.items():
        w = re.findall(r"[^\W_]+", (t or "").lower())
        shingles[i] = [tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))] if w else []
    number = {}
    seqs = {i: np.array([number.setdefault(x, len(number)) for x in s], dtype=np.uint64) for i, s in shingles.items()}
    holders = collections.defaultdict(set)
    for i, s in shingles.items():
        for x in s:
            holders[x].add(i)
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    empty = [i for i, s in shingles.items() if not s]
    links = list(zip(empty, empty[1:]))
    for i, s in shingles.items():
        rare = sorted(set(s), key=lambda x: len(holders[x]))[:len(s) // 5 + 2]
        links += [(i, j) for j in set().union(*(holders[x] for x in rare)) if j > i
                  and omh.similarity(seqs[i], seqs[j])] if rare else []
    for i, j in links:
        parent[find(i)] = find(j)
    out = collections.defaultdict(set)
    for i in texts:
        out[find(i)].add(i)
    return {frozenset(v) for v in out.values()}


def classes_of(rows):
    out = collections.defaultdict(set)
    for r in rows:
        out[r.class_id].add(r.doc_id)
    assert all(k == min(v) for k, v in out.items())
    return {frozenset(v) for v in out.values()}


def test_classes_of_a_table(spark, texts):
    rows = se.queries()["op5_order_minhash"](spark, SF).collect()
    assert classes_of(rows) == brute_classes(texts) and any(r.class_size > 1 for r in rows)
    assert all(r.representative == (r.doc_id == r.class_id) for r in rows)


def test_classes_of_a_large_group_and_a_shared_passage(spark):
    """A chain of edits, a group of near copies and texts that share only a passage."""
    rng = random.Random(2)
    base = [f"b{rng.randrange(400)}" for _ in range(200)]
    texts = {0: " ".join(base)}
    for k in range(1, 120):
        ws = base[:]
        for _ in range(3):
            ws[rng.randrange(200)] = f"n{rng.randrange(10_000)}"
        texts[k] = " ".join(ws)
    passage = [f"p{i}" for i in range(60)]
    for k in range(200, 260):
        texts[k] = " ".join([f"q{rng.randrange(10_000)}" for _ in range(40)] + passage)
    chain = [f"c{i}" for i in range(100)]
    for k in range(300, 320):
        texts[k] = " ".join(chain)
        chain[(k * 7) % 100] = f"d{k}"
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert classes_of(omh.near_duplicates(df).collect()) == brute_classes(texts)


def test_near_copies_inside_a_family_with_a_shared_passage(spark):
    """The copies agree in little but the passage that hundreds of other texts hold as well."""
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(91)]
    texts = {k: " ".join(passage + [f"q{k}x{i}" for i in range(13)]) for k in range(400)}
    for k in range(400, 460, 2):
        own = [f"q{k}x{i}" for i in range(13)]
        texts[k] = " ".join(passage + own)
        texts[k + 1] = " ".join(passage + own[:3] + [f"r{k}x{i}" for i in range(10)])
    df = spark.createDataFrame(rng.sample(list(texts.items()), len(texts)), "doc_id long, text string")
    want = {frozenset((k,)) for k in range(400)} | {frozenset((k, k + 1)) for k in range(400, 460, 2)}
    assert brute_classes(texts) == want
    assert classes_of(omh.near_duplicates(df).collect()) == want


def test_short_near_copies(spark):
    """Texts of 8 and 9 words: 4 of 5 shingles in common."""
    texts = {}
    for k in range(0, 1200, 2):
        texts[k] = " ".join(f"w{k}x{i}" for i in range(8))
        texts[k + 1] = f"{texts[k]} more{k}"
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert classes_of(omh.near_duplicates(df).collect()) == {frozenset((k, k + 1)) for k in range(0, 1200, 2)}


def test_exact_proposals_hold_every_similar_pair(spark, monkeypatch):
    """One class a text, and shingles dealt out to several salts."""
    monkeypatch.setattr(omh, "SALTED", 3)
    rng = random.Random(8)
    seqs = {}
    for k in range(120):
        base = seqs[rng.randrange(k)] if k and rng.random() < 0.8 else [rng.randrange(25) for _ in range(rng.randrange(1, 60))]
        seqs[k] = [x for x in base if rng.random() > 0.04] + [rng.randrange(25) for _ in range(rng.randrange(3))] or [0]
    arrays = {k: np.array(v, dtype=np.uint64) for k, v in seqs.items()}
    shingles = spark.createDataFrame([(k, v.tobytes()) for k, v in arrays.items()], "node long, shingles binary")
    members = spark.createDataFrame([(k, k) for k in seqs], "node long, class long")
    got = [tuple(r) for r in omh.exact_proposals(members, shingles).collect()]
    want = {(a, b) for a in seqs for b in seqs if a < b and omh.similarity(arrays[a], arrays[b])}
    assert want and want <= set(got) and len(got) == len(set(got))
    # inside a class there is nothing to propose
    one = spark.createDataFrame([(k, 0 if k else 1) for k in seqs], "node long, class long")
    assert {tuple(r) for r in omh.exact_proposals(one, shingles).collect()} >= {p for p in want if p[0] == 0}
    assert all(r.a == 0 for r in omh.exact_proposals(one, shingles).collect())


def test_near_duplicates_edge_rows(edge, empty, clashing):
    for df in (edge, clashing):
        rows = omh.near_duplicates(df).collect()
        assert len(rows) == len(EDGE_ROWS)
        by = collections.defaultdict(set)
        for r in rows:
            by[r.class_id].add(r.doc_id)
        assert by[1] == {1, 2, 7} and by[5] == {5} and by[None] == {None}
        kept = omh.keep_one(df)
        assert kept.columns == df.columns
        assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(map(str, [1, 3, 4, 5, 5, 6, 8, None]))
    assert omh.near_duplicates(empty).collect() == [] and omh.keep_one(empty).collect() == []


# -- pipeline --------------------------------------------------------------

def test_pipeline_stages(spark, documents, texts):
    """Each stage is judged on its own input."""
    from ledgerlens.llm.native import written

    from .test_text_rules import brute_overlaps
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = written(stage(spark, docs, SF), name)
        if name != "bpe_encoding":
            assert out.columns == documents.columns and dict(out.dtypes) == dict(documents.dtypes)
        after = {r.doc_id: (r.text if "text" in out.columns else None) for r in out.collect()}
        if name == "quality_classifier":
            scores = {r.doc_id: r.predicted for r in fm.quality(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
            assert set(after) == {i for i, p in scores.items() if p} and 0 < len(after) < len(before)
        elif name == "near_dedup":
            assert set(after) == {min(c) for c in brute_classes(before)}
        elif name == "decontamination":
            assert set(after) == set(before) - {i for i, _ in brute_overlaps(before.items(), items)} != set(before)
        elif name == "secret_scan":
            assert set(after) == set(before)
            assert not any(re.search(r"[0-9a-f]{24}|AKIA[A-Z0-9]{16}", t) for t in after.values())
            assert all(after[i] == t for i, t in before.items() if "[SECRET]" not in after[i])
        else:
            assert set(after) == set(before)
        docs = out
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, docs.collect()))


def test_pipeline_edge_rows(spark, edge, empty, clashing):
    for df in (edge, clashing, empty):
        docs = df
        for _, stage in corpus_pipeline.STAGES[1:]:
            docs = stage(spark, docs, SF)
        assert docs.count() == (0 if df is empty else 8)
