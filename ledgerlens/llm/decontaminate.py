"""Benchmark decontamination by spaced-seed hashing (built-in functions only).

1. Fixed masks of five kept positions each slide over the words of every
   benchmark item and every document; a seed is the hash of the kept words.
2. Document seeds are joined to item seeds; a match proposes an item and a
   diagonal (word place in the document minus place in the item).
3. Around each proposal the two texts are compared word by word on the
   diagonal.  The overlap is verified when a stretch of 13 item words (the
   whole item if it is shorter) agrees in at least 80 % of its places; items of five or six words must
   agree whole.

The masks hit every stretch of 7 to 13 words with the substitutions this allows.  Words are
runs of letters and digits of the lower-cased text.  Defined cases: null and
empty texts, and items of fewer than five words, match nothing; repeated rows
and repeated items give repeated results; a null doc_id is kept; empty tables
give no rows; texts and items of any length are compared whole; other columns
are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm.native import let, row_key, same, written

#: Positions that count are 1.
MASKS = ("11111", "110111", "1101011", "11100011")
STRETCH = 13
AGREE = 0.8
#: Items of fewer words must agree in all of them.
TOLERANT = 7
#: Item seeds (about 40 bytes each) up to which they are broadcast; beyond, both sides are shuffled by seed.
BROADCAST_SEEDS = 2_000_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[\\p{L}\\p{N}]+"), F.lit(0))


def seeds(frame: DataFrame) -> DataFrame:
    """A row for each mask and place of ``words``: ``seed``, ``at``; other columns are kept."""
    held = [c for c in frame.columns if c != "words"]
    shortest = min(map(len, MASKS))
    places = F.sequence(F.lit(0), F.size("words") - shortest)
    at = frame.where(F.size("words") >= shortest).select(*held, "words", F.explode(places).alias("at"))

    def seed(number: int, mask: str) -> Column:
        kept = [F.get("words", F.col("at") + i) for i, c in enumerate(mask) if c == "1"]
        return F.when(F.col("at") + len(mask) <= F.size("words"), F.xxhash64(F.lit(number), *kept))

    every = F.array(*(seed(n, m) for n, m in enumerate(MASKS)))
    return at.select(*held, "at", F.explode(every).alias("seed")).where(F.col("seed").isNotNull())


def overlap(words: Column, item: Column, diagonal: Column) -> Column:
    """Most agreeing places of a stretch of the item on the diagonal; 0 if none reaches the share."""
    length = F.least(F.lit(STRETCH), F.size(item))
    agree = F.transform(item, lambda w, i: (F.coalesce(F.get(words, i + diagonal) == w, F.lit(False))).cast("int"))
    starts = F.sequence(F.lit(1), F.size(item) - length + 1)
    best = let(agree, lambda a: F.array_max(F.transform(starts, lambda i: F.aggregate(
        F.slice(a, i, length), F.lit(0), lambda sum, x: sum + x))))
    least = F.when(length < TOLERANT, length).otherwise(F.ceil(length * AGREE))
    return let(best, lambda n: F.when(n >= least, n).otherwise(0))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, key (of the text), item_id and ``matched_words`` for each document text and item that overlap."""
    own = docs.select(F.col(id_col).alias("doc_id"), row_key(F.col(text_col)).alias("key"),
                      F.col(text_col).alias("text"))
    tests = items.select(F.col(item_col).alias("item_id"), words_of(F.col(item_text_col)).alias("words")) \
        .where(F.size("words") >= min(map(len, MASKS))).distinct()
    keyed = tests.withColumn("item_key", F.xxhash64("item_id", "words"))
    test_seeds = written(seeds(keyed.drop("item_id")).select("item_key", F.col("at").alias("item_at"), "seed"), "seeds")
    fits = test_seeds.count() <= BROADCAST_SEEDS
    train_seeds = seeds(own.select("doc_id", "key", words_of(F.col("text")).alias("words")))
    # (document, item, diagonal), each once, however many seeds propose it
    proposed = written(train_seeds.join(F.broadcast(test_seeds) if fits else test_seeds, "seed").select(
        F.col("doc_id").alias("p_id"), F.col("key").alias("p_key"), "item_key",
        (F.col("at") - F.col("item_at")).alias("diagonal")).distinct(), "proposals")
    with_item = proposed.join(F.broadcast(keyed) if fits else keyed, "item_key").withColumnRenamed("words", "item")
    joined = own.join(with_item, (F.col("key") == F.col("p_key")) & same(F.col("doc_id"), F.col("p_id")))
    # a text is split once a row, not once an item word
    matched = let(words_of(F.col("text")), lambda words: overlap(words, F.col("item"), F.col("diagonal")))
    checked = joined.select("doc_id", "key", "item_id", matched.alias("matched"))
    return checked.where(F.col("matched") > 0).groupBy("doc_id", "key", "item_id").agg(
        F.max("matched").cast("long").alias("matched_words"))


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` (columns doc_id, text and any others) without the documents that overlap an item."""
    bad = contaminated(docs, items).select(F.col("doc_id").alias("bad_id"), F.col("key").alias("bad_key")).distinct()
    match = (row_key(docs["text"]) == bad["bad_key"]) & same(docs["doc_id"], bad["bad_id"])
    return docs.join(bad, match, "left_anti")
