"""WARC archives, cover-tree mining and cross-tokenizer alignment against brute force."""

import collections
import gzip
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se
from ledgerlens.llm import cover_tree as ct, token_alignment as ta, warc

from .conftest import CLASHING, EDGE_ROWS, SF

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# -- archives --------------------------------------------------------------

def brute_captures(pages):
    """(page_id, bytes, digest, type, refers_to) by a pass over all payloads."""
    first = {}
    for i, _, html in pages:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    out = []
    for i, _, html in pages:
        raw = (html or "").encode("utf-8")
        lead = first.get(html or "")
        again = len(raw) >= 100 and lead != i
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", lead if again else None))
    return sorted(out, key=repr)


PAGES = [
    (5, "http://a/x", "x" * 200), (3, "http://a/y?q=1#f", "x" * 200), (3, "http://a/y?q=1#f", "x" * 200),
    (None, "http://a/n", "x" * 200), (7, None, "short"), (8, "http://a b/\r\nWARC-Type: x", "short"), (9, None, None),
    (10, "u", "é" * 50), (11, "u", "é" * 50), (12, "u", "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"),
    (None, "p", "y" * 150), (None, "q", "y" * 150), (-4, "", "long " * 40_000), (14, "u", "\x00\x01 \U0001f389" * 30),
]


def archived(spark, pages, folder):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    warc.write_warc(df, folder, file_bytes=5_000)
    return df


def test_archives_of_a_table(spark):
    pages = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html").collect()]
    got = sorted(map(tuple, se.queries()["op11_warc"](spark, SF).collect()), key=repr)
    assert got == brute_captures(pages)


def test_captures_are_assembled_through_their_identifiers(spark, tmp_path):
    folder = str(tmp_path / "w")
    archived(spark, PAGES, folder)
    assert sorted(map(tuple, warc.archive_report(spark, folder).collect()), key=repr) == brute_captures(PAGES)
    files = list((tmp_path / "w").glob("*.gz"))
    assert len(files) > 3
    # every record by an own reading of the format
    held = collections.Counter(f["warc-type"] for p in files for f, _ in warc.records_in(p.read_bytes()))
    kinds = collections.Counter(r[3] for r in brute_captures(PAGES))
    assert held == kinds + collections.Counter(request=len(PAGES), metadata=len(PAGES))
    rows = warc.captures(spark, folder).collect()
    assert sorted((r.uri is None, bytes(r.payload)) for r in rows) == sorted(
        (u is None, (h or "").encode("utf-8")) for _, u, h in PAGES)
    assert all(r.n_request and r.n_metadata and r.request.content.startswith("GET ") for r in rows)
    assert {r.response.recorded_digest for r in rows} == {"sha256:" + r.response.payload_digest for r in rows}


def test_records_of_one_capture_lie_anywhere_and_name_each_other_either_way(spark, tmp_path):
    def record(kind, i, block, **more):
        head = "".join(f"{k.replace('_', '-')}: {v}\r\n" for k, v in more.items())
        return (f"WARC/1.0\r\nWARC-Type: {kind}\r\nwarc-record-id: <{i}>\r\n{head}Content-Length: {len(block)}\r\n\r\n"
                ).encode() + block + b"\r\n\r\n"
    page = b"HTTP/1.1 200 OK\r\n\r\nhello"
    one = record("metadata", "m1", b"page-id: 1\r\n", WARC_Concurrent_To="<r1>") + record("response", "r2", page)
    two = record("warcinfo", "w", b"software: none") + record("response", "r1", page, WARC_Concurrent_To="<q1>")
    three = record("request", "q1", b"GET /1", WARC_Concurrent_To="<r1>") + record("request", "q2", b"GET /2", WARC_Concurrent_To="<r2>") \
        + record("metadata", "m0", b"page-id: 0\r\n", WARC_Concurrent_To="<r1>") + record("request", "lost", b"GET /3", WARC_Concurrent_To="<none>")
    (tmp_path / "a").mkdir()
    for k, part in enumerate((one, two, gzip.compress(three[:200]) + gzip.compress(three[200:]))):
        (tmp_path / "a" / f"{k}.warc").write_bytes(part)
    rows = {r.record_id: r for r in warc.captures(spark, str(tmp_path / "a")).collect()}
    assert set(rows) == {"<r1>", "<r2>"}
    assert rows["<r1>"].request.content == "GET /1" and rows["<r1>"].n_request == 1
    assert rows["<r1>"].metadata.record_id == "<m0>" and rows["<r1>"].n_metadata == 2
    assert rows["<r2>"].request.content == "GET /2" and rows["<r2>"].metadata is None and rows["<r2>"].n_metadata == 0
    assert bytes(rows["<r2>"].payload) == b"hello"
    for broken in (one[:-20], b"WARC/1.0\r\nWARC-Type: x\r\n\r\nbody", b"no record"):
        with pytest.raises(ValueError):
            list(warc.records_in(broken))


def test_archives_of_edge_tables(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_warc(empty, str(tmp_path / "e"))
    assert warc.archive_report(spark, str(tmp_path / "e")).collect() == []
    more = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    names = [*CLASHING, "bytes", "digest", "first", "again", "value", "request", "response", "metadata", "n", "shared"]
    warc.write_warc(more.select("*", *(F.lit(f"own {c}").alias(c) for c in names)), str(tmp_path / "c"))
    assert sorted(map(tuple, warc.archive_report(spark, str(tmp_path / "c")).collect()), key=repr) == brute_captures(PAGES)


# -- cover trees -----------------------------------------------------------

def brute_negatives(rows, anchor=lambda i: i % 100 == 0, positives=5, negatives=5):
    """Every inner product in Python's whole numbers."""
    part = sorted({(i, (l + 1) % 10 if i % 7 == 0 else l, tuple(int(np.floor(256 * float(x))) for x in v))
                   for i, l, v in rows if i is not None and l is not None and v is not None
                   and all(x is not None and np.isfinite(x) for x in v)})
    out = []
    for a in part:
        if not anchor(a[0]):
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1]) for b in part if b != a)
        for s, p, _ in [x for x in scored if x[2] == a[1]][:positives]:
            fit = [x for x in scored if x[2] != a[1] and -80 * s <= -100 * x[0] <= -100 * s][:negatives]
            out += [(a[0], p, k, n, -s, -t) for k, (t, n, _) in enumerate(fit, 1)]
    return sorted(out)


def mined(df, **more):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(map(tuple, ct.hard_negatives(df, more.pop("anchors", F.col("vec_id") % 100 == 0), label, **more).collect()))


def test_negatives_of_a_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    got = sorted(map(tuple, se.queries()["op12_cover_tree"](spark, SF).collect()))
    assert got == brute_negatives(rows) and got


def test_tree_covers_and_search_is_exact():
    rng = np.random.default_rng(3)
    for n, wide in ((0, 4), (1, 4), (40, 3), (700, 2), (600, 16)):
        v = rng.integers(-40, 40, (n, wide)).astype(np.int64)
        v[n // 2:] = v[n // 2:] * (rng.random((n - n // 2, 1)) < 0.3)
        tree = ct.Tree(v)
        assert sorted(tree.order.tolist()) == list(range(n))
        sizes = (v * v).sum(axis=1)
        for i in range(len(tree.start) if n else 0):
            own = tree.order[tree.start[i]:tree.stop[i]]
            c = own[0]
            last = np.sqrt(tree.most - sizes)
            far = np.sqrt(((v[own] - v[c]) ** 2).sum(axis=1) + (last[own] - last[c]) ** 2)
            assert far.max() <= tree.radius[i]
            low, high = tree.bounds(v[0], slice(i, i + 1))
            assert low[0] <= (v[own] @ v[0]).min() and (v[own] @ v[0]).max() <= high[0]
            if tree.children[i]:
                spans = [(tree.start[j], tree.stop[j]) for j in range(tree.child[i], tree.child[i] + tree.children[i])]
                assert spans[0][0] == tree.start[i] and spans[-1][1] == tree.stop[i]
                assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        again = ct.Tree.loaded(tree.stored()) if n else tree
        rank = rng.permutation(n)
        for _ in range(12):
            q = rng.integers(-40, 40, wide).astype(np.int64)
            windows = [(-10 ** 9, 10 ** 9), (0, 300), (-50, -20), (40, 39)]
            skip = int(rng.integers(n)) if n else -1
            for (low, high), found in zip(windows, again.search(q, windows, rank, 4, skip)):
                want = sorted((-int(s), int(rank[r]), r) for r, s in enumerate(v @ q) if low <= s <= high and r != skip)[:4]
                assert found == [(-s, r) for s, _, r in want]


def test_negatives_over_many_trees_and_packs(spark, monkeypatch):
    """Ties, repeated rows, a hot label and one vector that a third of all rows hold."""
    monkeypatch.setattr(ct, "BLOCK", 40)
    monkeypatch.setattr(ct, "PACK", 3)
    rng = random.Random(4)
    same = [rng.gauss(0, 0.2) for _ in range(8)]
    rows = []
    for i in range(600):
        v = same if i % 3 == 0 else [round(rng.gauss(0, 0.2), 1) for _ in range(8)]
        rows.append((i, 1 if i % 2 else rng.randrange(4), v))
    rows += rows[:30]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    stored = [(r.vec_id, r.label, r.embedding) for r in df.collect()]
    got = mined(df, anchors=F.col("vec_id") % 20 == 0)
    assert got == brute_negatives(stored, lambda i: i % 20 == 0) and len(got) > 300


def test_negatives_of_edge_tables(spark):
    schema = "vec_id long, label int, embedding array<float>"
    rows = [(0, 1, [0.5, 0.5]), (100, 3, [0.25, 1.0]), (1, 2, [0.5, 0.25]), (2, 2, [0.5, 0.5]), (3, 1, [0.25, 0.5]),
            (4, 1, None), (5, None, [1.0, 1.0]), (6, 1, [1.0, None]), (8, 1, [float("nan"), 1.0]),
            (9, 1, [float("inf"), 1.0]), (10, 2, []), (11, 2, [0.5]), (12, 1, [0.5, 0.5, 0.0]), (None, 1, [0.5, 0.5]),
            (200, 2, [0.0, 0.0]), (13, 1, [3.0e38, 1.0])]
    df = spark.createDataFrame(rows, schema)
    kept = [r for r in rows if r[0] != 13]
    want = brute_negatives(kept)
    assert mined(df) == want and want
    names = [*(c for c in CLASHING if c not in df.columns), "vec", "tag", "raw", "pivot", "part", "group", "low"]
    assert mined(df.select("*", *(F.lit(f"own {c}").alias(c) for c in dict.fromkeys(names)))) == want
    assert mined(spark.createDataFrame([], schema)) == [] == mined(df.where("vec_id in (1, 2)"))


# -- alignment -------------------------------------------------------------

@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATH_B)


def brute_groups(libraries, text):
    """Groups by a set of all ends, from the libraries' tokens of the whole text."""
    a, b = libraries
    text = text or ""
    if not text:
        return []
    of = {c: x for x, c in enumerate(ta.byte_symbols())}
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    raw_a = [bytes(of[c] for c in a.id_to_token(i)) if i != 50256 else b"<|endoftext|>" for i in ids_a]
    raw_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode("utf-8")
             for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
    if b"".join(raw_a) != (" " + text).encode("utf-8") != b"" or b"".join(raw_b) != (" " + text).encode("utf-8"):
        return []
    ends_a, ends_b = np.cumsum(list(map(len, raw_a))).tolist(), np.cumsum(list(map(len, raw_b))).tolist()
    shared = sorted(set(ends_a) & set(ends_b))
    return [([i for i, e in zip(ids_a, ends_a) if low < e <= high], [i for i, e in zip(ids_b, ends_b) if low < e <= high])
            for low, high in zip([0, *shared], shared)]


def brute_alignment(libraries, docs):
    all_groups = [brute_groups(libraries, t) for _, t in docs]
    holders = collections.Counter(p for gs in all_groups for p in {(a, b) for x, y in gs for a in x for b in y})
    most = collections.Counter()
    for (a, _), n in holders.items():
        most[a] = max(most[a], n)
    out = []
    for (i, _), gs in zip(docs, all_groups):
        links = [(a, b) for x, y in gs for a in x for b in y]
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in gs)
        out.append((i, sum(len(x) for x, _ in gs), sum(len(y) for _, y in gs), len(gs), len(links),
                    sum(holders[p] == most[p[0]] for p in links), sum(holders[p] for p in links),
                    hashlib.sha256(told.encode()).hexdigest() if gs else ""))
    return sorted(out, key=repr)


def test_groups_are_cut_at_every_shared_end():
    rng = random.Random(6)
    for _ in range(400):
        n = rng.randrange(1, 60)
        a, b = (sorted(set(rng.sample(range(1, n + 1), rng.randrange(n)) + [n])) for _ in "ab")
        shared = sorted(set(a) & set(b))
        want, i, j = [], 0, 0
        for e in shared:
            want.append((i, a.index(e) + 1, j, b.index(e) + 1))
            i, j = want[-1][1], want[-1][3]
        assert ta.groups_of(a, b) == want
    assert ta.groups_of([], []) == []
    # a long interval without a cut, and cuts at one end only
    odd, even = list(range(1, 40_001, 2)) + [40_002], list(range(2, 40_003, 2))
    assert ta.groups_of(odd, even) == [(0, len(odd), 0, len(even))]


def test_alignment_of_a_table(spark, texts, libraries):
    got = se.queries()["op13_token_alignment"](spark, SF).collect()
    assert sorted(map(tuple, got), key=repr) == brute_alignment(libraries, list(texts.items()))


ODD = ["a  b", " a", "a\n b", "\n\nx\t y", "x ", "   ", "a▁b", "<|endoftext|> <s>hi</s>", "é ﬁ ½ ² 漢字 🎉", "a\x00b\x1fc",
       "it's we'll word.word,word ... !!", "if (x) {\r\n}\r\n", "-1.5e10%", "ÀÉ ÿ Łódź", "\ttab", "éa", "q" * 3000,
       "Ünïcödé—dash “quoted” …", "12345678901234567890", "  　wide"]


def test_alignment_of_odd_texts_in_small_blocks(spark, edge, empty, clashing, libraries, monkeypatch):
    monkeypatch.setattr(ta, "BLOCK_CHARS", 60)
    docs = list(enumerate(ODD)) + [(3, "a\n b"), (3, "another"), (None, "no id")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, ta.align(df, PATH_A, PATH_B).collect()), key=repr) == brute_alignment(libraries, docs)
    want = brute_alignment(libraries, [(r[0], r[1]) for r in EDGE_ROWS])
    for frame in (edge, clashing.withColumn("block", F.lit("own"))):
        assert sorted(map(tuple, ta.align(frame, PATH_A, PATH_B).collect()), key=repr) == want
    assert ta.align(empty, PATH_A, PATH_B).collect() == []
