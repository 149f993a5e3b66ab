"""Quality rules with a hashed n-gram log-likelihood ratio (built-in functions only).

Base rules measure words, symbols, repeated lines and repeated windows of a
text.  The method then compares two multinomials over hashed unigrams and
bigrams: that of a trusted target (documents without junk symbols, repeated
lines or shouting, of 50 tokens or more) and that of the raw corpus (all
documents).  A document's score is the mean, over its n-grams, of
``ln p_target - ln p_raw`` with add-one smoothing; it is kept when it passes
the base rules and scores at least the threshold.  Ratios are whole
millionths, so sums do not depend on the order of the rows.

Words are runs of anything but ASCII white space.  Tokens of the n-grams are
runs of letters and digits or runs of other characters of the lower-cased
text.  Defined cases: null and empty texts have no words and fail the base
rules; a text without tokens scores 0; repeated rows give repeated results;
without any trusted document all ratios come from smoothing alone; an empty
table gives no rows; texts of any length are scored whole; a null doc_id is
kept; only doc_id and text are read, so names of other columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm.native import let
from ledgerlens.session import ensure_checkpoint_dir

BUCKETS = 65_536
THRESHOLD = -0.3
WINDOW = 8
MIN_WORDS = 20
TRUSTED_TOKENS = 50
_SPACE = "[ \\t-\\r]"
_UNIT = 1_000_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{_SPACE}+", -1), "")


def tokens_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}\\s]+"), F.lit(0))


def n_symbols(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[#*$%&|<>]"))


def n_dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike("[^ \\t-\\r]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def n_repeat_words(words: Column) -> Column:
    """Words inside 8-word windows that occur twice or more, the first occurrence included."""
    none = F.array().cast("array<bigint>")
    hashes = let(words, lambda w: F.when(F.size(w) >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))).otherwise(none))

    def covered(h: Column) -> Column:
        # equal windows are neighbours once sorted; places of the repeated ones, then the union of their words
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))

        def places(s: Column) -> Column:
            def like(k: Column, other: Column) -> Column:
                return F.coalesce(F.get(s, k)["h"] == F.get(s, other)["h"], F.lit(False))

            again = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda k: like(k, k - 1) | like(k, k + 1))
            return F.sort_array(F.transform(again, lambda k: F.get(s, k)["at"]))

        def add(acc: Column, at: Column) -> Column:
            return F.struct((at + WINDOW).alias("to"),
                            (acc["n"] + F.least(F.lit(WINDOW), at + WINDOW - acc["to"])).alias("n"))

        start = F.struct(F.lit(0).alias("to"), F.lit(0).alias("n"))
        return F.aggregate(let(placed, places), start, add, lambda acc: acc["n"])

    return let(hashes, lambda h: F.when(F.size(h) == F.size(F.array_distinct(h)), F.lit(0)).otherwise(covered(h)))


def base_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and the base measures, one row per input row."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    split = own.withColumn("words", words_of(F.col("text")))
    return split.select(
        "doc_id", "text", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        n_symbols(F.col("text")).cast("long").alias("n_symbols"),
        n_dup_lines(F.col("text")).cast("long").alias("n_dup_lines"),
        n_repeat_words(F.col("words")).cast("long").alias("n_repeat_words"))


def is_trusted(text: Column, tokens: Column) -> Column:
    """The target corpus: at least 50 tokens, no junk symbol, no shouting, no repeated line.
    The cheap conditions come first; the rest is only read where they hold."""
    shouting = F.regexp_count(text, F.lit("[A-Z]{4}")) * 20 > F.size(tokens)
    return ((F.size(tokens) >= TRUSTED_TOKENS) & ~text.rlike("[#*$%&|<>]|!!") & ~shouting & (n_dup_lines(text) == 0))


def _ngrams(frame: DataFrame) -> DataFrame:
    """A row for each unigram and each bigram with its bucket; a row without
    tokens keeps one row with the bucket -1, which no ratio has."""
    def bucket(*parts: Column) -> Column:
        return F.pmod(F.xxhash64(*parts), F.lit(BUCKETS)).cast("int")

    held = [c for c in frame.columns if c != "tokens"]
    places = F.when(F.size("tokens") > 0, F.sequence(F.lit(0), F.size("tokens") - 1)).otherwise(F.array(F.lit(-1)))
    at = frame.select(*held, "tokens", F.explode(places).alias("at"))
    one, two = F.get("tokens", F.col("at")), F.get("tokens", F.col("at") + 1)
    single = F.when(F.col("at") < 0, F.lit(-1)).otherwise(bucket(one))
    pair = F.when((F.col("at") >= 0) & (F.col("at") + 1 < F.size("tokens")), bucket(one, two))
    return at.select(*held, F.explode(F.array(single, pair)).alias("bucket")).where(F.col("bucket").isNotNull())


def llr_table(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """bucket and ``llr`` (millionths): counted over all documents, ``BUCKETS`` rows at most."""
    ensure_checkpoint_dir(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    split = docs.select(text.alias("text"), tokens_of(text).alias("tokens"))
    marked = split.select("tokens", is_trusted(F.col("text"), F.col("tokens")).cast("int").alias("trusted"))
    counts = _ngrams(marked).where(F.col("bucket") >= 0).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("raw"), F.sum("trusted").alias("target")).checkpoint()
    total = counts.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("raw"),
                       F.coalesce(F.sum("target"), F.lit(0)).alias("target")).head()
    ratio = (F.log((F.col("target") + 1) / F.lit(float(total.target + BUCKETS)))
             - F.log((F.col("raw") + 1) / F.lit(float(total.raw + BUCKETS))))
    return counts.select("bucket", F.round(ratio * _UNIT).cast("long").alias("llr"))


def judge(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base measures, ``llr_score`` (mean of the ratios) and the verdict of every document."""
    # the broadcast side has at most BUCKETS rows of 12 bytes, whatever the corpus
    ratios = F.broadcast(llr_table(docs, text_col))
    held = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    stats = base_rules(docs, id_col, text_col).select(
        F.monotonically_increasing_id().alias("row"), *held, tokens_of(F.col("text")).alias("tokens"))
    # numbers only, so that the sums stay in a hash aggregate and leave each task as one row a document
    scored = _ngrams(stats).join(ratios, "bucket", "left").groupBy("row").agg(
        *(F.first(c).alias(c) for c in held), F.sum(F.coalesce("llr", F.lit(0))).alias("total"),
        F.sum((F.col("bucket") >= 0).cast("long")).alias("grams"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    # total / grams >= threshold, in whole numbers
    passes = F.col("total") >= F.lit(round(threshold * _UNIT)) * F.col("grams")
    return scored.select(
        *held, failed.alias("base_failed"), (~failed & passes).alias("kept"),
        F.when(F.col("grams") > 0, F.col("total") / F.col("grams") / _UNIT).otherwise(0.0).alias("llr_score"))
