"""Token counts, BPE codec and id files against the tokenizers library."""

import hashlib
import random
import tempfile
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import id_files, pair_index_bpe, prefix_tokens
from ledgerlens.llm.textual import Cache, library_tokenizer

from .conftest import EDGE_ROWS, SF

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
TRICKY = ["it's we'll they've i'd 'll 'l !'s o''s", "a<|endoftext|>b !!<|endoftext|>", "é ß Œ 12 ½ ²", "",
          "  x \n\n y ", "aaaaaaaaaaaaaaaa aaaa bbbbbbbbb", " a  b \nc\t\td ", "x" * 300 + " " * 77 + "=" * 99,
          "the 漢字 İstanbul Σς 🎉 é"]


def ids(path, text):
    return library_tokenizer(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", TRICKY)
def test_count_is_the_librarys(text):
    assert prefix_tokens.counter(WORD).count(text) == len(ids(WORD, text))


@pytest.mark.parametrize("text", TRICKY[:-1])
def test_table_is_exact_at_every_prefix(text):
    own = prefix_tokens.counter(WORD)
    assert own.table(text) == [len(ids(WORD, text[:k])) for k in range(len(text) + 1)]


def test_tables_and_cuts_of_random_words():
    rng, own = random.Random(5), prefix_tokens.counter(WORD)
    for _ in range(60):
        text = " ".join("".join(rng.choices("theionandrs'.,é", k=rng.randint(1, 14))) for _ in range(12))
        table = [len(ids(WORD, text[:k])) for k in range(len(text) + 1)]
        assert own.table(text) == table
        for budget in (0, 1, 7, 20):
            assert own.cut(text, budget) == max(k for k, n in enumerate(table) if n <= budget)


def test_prefix_table_column(spark):
    df = spark.createDataFrame([("ab cd",), (None,)], "text string")
    got = [r.t for r in df.select(prefix_tokens.prefix_table(F.col("text"), WORD).alias("t")).collect()]
    assert got == [[len(ids(WORD, "ab cd"[:k])) for k in range(6)], [0]]


def test_token_counts_edge_rows(edge, empty, clashing):
    want = sorted((str(i), len((t or "").encode()), len(ids(WORD, t or ""))) for i, t, *_ in EDGE_ROWS)
    for df in (edge, clashing):
        rows = prefix_tokens.token_counts(df, WORD).collect()
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in rows) == want
        assert all(r.over_limit == (r.n_tokens > 2048) for r in rows)
        long = max(rows, key=lambda r: r.n_tokens)
        text = next(t for i, t, *_ in EDGE_ROWS if i == long.doc_id)
        assert len(ids(WORD, text[:long.cut_chars])) <= 2048 < len(ids(WORD, text[:long.cut_chars + 3]))
    assert prefix_tokens.token_counts(empty, WORD).collect() == []


def test_cache_keeps_what_is_in_use():
    made = []
    cache = Cache(lambda k: made.append(k) or k, bound=3)
    for k in (1, 2, 3, 4, 1, 5, 1):
        assert cache[k] == k
    assert made == [1, 2, 3, 4, 5] and len(cache) <= 3


@pytest.mark.parametrize("text", TRICKY)
def test_codec_matches_the_library(text):
    own = pair_index_bpe.codec(BYTE)
    got = own.encode([text])[0]
    assert np.frombuffer(got, "<u4").tolist() == ids(BYTE, text)
    assert own.decode(got).decode() == library_tokenizer(BYTE).decode(ids(BYTE, text), skip_special_tokens=False)


def test_every_merge_ranks_after_its_parts():
    own = pair_index_bpe.PairIndexBpe(BYTE)
    born = {int(m): r for r, m in reversed(list(enumerate(own.made)))}
    assert all(born.get(int(x), -1) < r for r, (a, b) in enumerate(zip(own.left, own.right)) for x in (a, b))


def test_decoding_cut_bytes():
    own = pair_index_bpe.codec(BYTE)
    part = np.frombuffer(own.encode(["🎉"])[0], "<u4")[:1]
    assert own.decode(part.tobytes()).decode() == library_tokenizer(BYTE).decode(part.tolist())


def test_round_trip_edge_rows(spark, edge, empty, clashing):
    def digests(t):
        i = ids(BYTE, t)
        text = library_tokenizer(BYTE).decode(i, skip_special_tokens=False)
        return (len(i), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())

    want = sorted((str(i), *digests(t or "")) for i, t, *_ in EDGE_ROWS)
    for df in (edge, clashing):
        rows = pair_index_bpe.round_trip(df, BYTE).collect()
        assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == want
    assert pair_index_bpe.round_trip(empty, BYTE).collect() == []
    back = edge.select("text", pair_index_bpe.decode_ids(pair_index_bpe.encode_ids(F.col("text"), BYTE), BYTE).alias("b"))
    assert all((r.text or "") == r.b for r in back.collect())


def expected_files(rows):
    """Rows in file order: ids ascending, null first; starts follow."""
    at, out = 0, []
    for i, t in rows:
        own = ids(WORD, t or "") + [1]
        out.append((i, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        at += len(own)
    return out


def test_id_files_of_a_table(spark, documents, texts):
    out = tempfile.mkdtemp(prefix="ll-ids-", dir="/tmp") + "/files"
    id_files.write_id_files(documents, WORD, out)
    got = [tuple(r) for r in id_files.read_id_files(spark, out).orderBy("start").collect()]
    assert got == expected_files(sorted(texts.items()))
    some = sorted(texts)[17]
    assert [x.tolist() for x in id_files.fetch_document(spark, out, some)] == [ids(WORD, texts[some]) + [1]]
    assert id_files.fetch_document(spark, out, -5) == []


def test_id_files_edge_rows(spark, edge, empty, clashing):
    for df in (edge, clashing):
        out = tempfile.mkdtemp(prefix="ll-ids-", dir="/tmp") + "/files"
        id_files.write_id_files(df, WORD, out)
        got = [tuple(r) for r in id_files.read_id_files(spark, out).orderBy("start").collect()]
        assert [g[0] for g in got] == sorted((i for i, *_ in EDGE_ROWS), key=lambda i: (i is not None, i))
        assert sorted((str(g[0]), g[2], g[3]) for g in got) == sorted(
            (str(w[0]), w[2], w[3]) for w in expected_files([(i, t) for i, t, *_ in EDGE_ROWS]))
        assert all(b[1] == a[1] + a[2] for a, b in zip(got, got[1:])) and got[0][1] == 0
        assert len(id_files.fetch_document(spark, out, 5)) == 3
    out = tempfile.mkdtemp(prefix="ll-ids-", dir="/tmp") + "/files"
    id_files.write_id_files(empty, WORD, out)
    assert id_files.read_id_files(spark, out).collect() == []


def test_a_changed_dictionary_is_noticed(spark, edge):
    out = tempfile.mkdtemp(prefix="ll-ids-", dir="/tmp") + "/files"
    id_files.write_id_files(edge, WORD, out)
    spark.createDataFrame([("0" * 64, bytearray(b"other"))], "dict_sha256 string, dictionary binary") \
        .write.mode("overwrite").parquet(f"{out}/dictionary")
    with pytest.raises(ValueError):
        id_files.read_id_files(spark, out)


def test_registered_token_queries(spark, texts):
    import __spark_entry__ as se
    q = se.queries()
    n = {r.doc_id: r.n_tokens for r in q["op3_token_counts"](spark, SF).collect()}
    assert n == {i: len(ids(WORD, t)) for i, t in texts.items()}
    files = [tuple(r) for r in q["op9_id_files"](spark, SF).orderBy("start").collect()]
    assert files == expected_files(sorted(texts.items()))
    bpe = {r.doc_id: r for r in q["op6_bpe_codec"](spark, SF).collect()}
    assert all(bpe[i].n_tokens == len(ids(BYTE, t)) and bpe[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
               for i, t in texts.items())
