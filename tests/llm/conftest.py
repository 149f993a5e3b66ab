"""Small fixtures shared by the tests of the llm operators."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside.
CLASHING = ("key", "node", "class", "kept", "kept_id", "kept_key", "bad_key", "row", "bucket", "words", "seed", "at",
            "score", "y", "kinds", "band", "sketch", "term", "path", "licence", "tie", "place", "one_of_equal_rows")

LONG = ("alpha beta gamma delta epsilon zeta eta theta iota kappa " * 3000).strip()
SECRET = "intro token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" end"
#: Nulls, empty and very long texts, one word of 5000 letters, ties on doc_id, repeated rows, odd characters.
EDGE_ROWS = [
    (1, None, None, None, None),
    (2, "", "en", "src0", 0),
    (3, LONG, "en", "src0", len(LONG)),
    (4, "x" * 5000, "en", "src0", 5000),
    (5, SECRET, "en", "src1", len(SECRET)),
    (5, SECRET, "en", "src1", len(SECRET)),
    (5, "another text under the same id", "en", "src1", None),
    (6, "é é 漢字 İstanbul Σς 🎉 ½ ² \x1f end", "xx", None, 12),
    (7, "   \n\t \r\n ", "en", "src0", 8),
    (8, "a<|endoftext|>b !!<|startoftext|> it's we'll o'clock", "en", "src0", 40),
    (None, "a row without an id", None, "src0", 19),
]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(EDGE_ROWS, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(spark, edge):
    from pyspark.sql import functions as F
    return edge.select("*", *(F.lit(f"own {c}").alias(c) for c in CLASHING))


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 0), (4, 0, 1), (4, 1, 1), (5, 1, 0), (None, 1, 1),
                                  (7, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
