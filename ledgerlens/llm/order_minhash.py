"""Near-duplicate classes by Order MinHash, verified by banded alignment.

Every text is a sequence of five-word shingles (words: runs of letters and
digits of the lower-cased text; a text of one to four words is one shingle).
Each of ``SKETCHES`` sketches takes the ``PICKED`` smallest occurrence-labelled
shingles under its own order and hashes them in text order, so that equal
sketches are likely only where much of the text agrees in the same order.
Texts with an equal sketch share a bucket.  The leader of a bucket is its
member with the most company over all its buckets - in a group of edited copies
that is the text they were made from.  Every text is proposed with the
``PROPOSALS`` leaders it shares most sketches with, which is linear in the
number of texts.  What this leaves apart is settled exactly: the members of
every bucket that still holds several classes, and all texts of at most
``SHORT`` shingles with their possible partners, are joined by their rarest
shingles, of which two similar texts always share one; pairs inside a class
are never made.  Of these pairs each text first tries one of every other class,
then the pairs whose classes are still different follow.  A proposal is
verified by a banded alignment of the two shingle sequences: similarity is
L / (a + b - L) for an alignment of L shingles, and 0.8 bounds the band.
Classes are the connected components.  So a pair is missed only if a text of
more than ``SHORT`` shingles has no sketch in common with its partner.

Defined cases: texts with the same words are one class, null, empty and
wordless texts being one too; a class is named by its smallest doc_id (null
only if all are null); a null doc_id is kept; rows that share a doc_id are
told apart by their text; repeated rows give repeated results; an empty table
gives no rows; texts of any length are taken whole (they travel to the workers
in batches of ``BATCH_ROWS`` rows); columns other than doc_id and text are
never read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ledgerlens.llm.native import row_key, same, small_batches, written
from ledgerlens.llm.textual import Cache, keep_only, slices

SHINGLE = 5
PICKED = 4
SKETCHES = 24
SIMILAR = 0.8
#: Leaders that a text is compared with before the exact join.
PROPOSALS = 3
#: Rows of texts or pairs of shingle sequences that a worker holds at once.
BATCH_ROWS = 256
#: Texts of at most this many shingles find their partners without sketches.
SHORT = 30
_WORD = re.compile(r"[^\W_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Hash values held at once while the sketches of one text are made.
_AT_ONCE = 1 << 20

_word_hash = Cache(lambda w: xxhash.xxh3_64_intdigest(w.encode("utf-8")), 200_000)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingles_of(words: list[str]) -> np.ndarray:
    """Hashes of the shingles in text order."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(_word_hash.__getitem__, words), dtype=np.uint64, count=len(words))
    size = min(SHINGLE, len(h))
    out = np.zeros(len(h) - size + 1, dtype=np.uint64)
    for i in range(size):
        out = _mixed(out + h[i:len(h) - size + 1 + i] + np.uint64(i + 1))
    return out


def labelled_of(shingles: np.ndarray) -> np.ndarray:
    """The shingles told apart by their occurrence in the text."""
    s = np.sort(shingles)
    if not (s[1:] == s[:-1]).any():
        return _mixed(shingles)
    n = len(shingles)
    by = np.argsort(shingles, kind="stable")
    s = shingles[by]
    new = np.concatenate((np.ones(min(1, n), dtype=bool), s[1:] != s[:-1]))
    nth = np.empty(n, dtype=np.uint64)
    nth[by] = np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))
    return _mixed(shingles + nth * np.uint64(0xD1B54A32D192ED03))


def _smallest(order: np.ndarray, take: int) -> np.ndarray:
    """Places of the ``take`` smallest values of each row, ascending.  In long
    rows only values under a bound that nearly always leaves enough are sorted."""
    count, n = order.shape
    if n > 64:
        under = order < np.uint64((1 << 64) // n * 14)
        rows, cols = np.nonzero(under)
        held = np.bincount(rows, minlength=count)
        if held.min() >= take:
            at = np.arange(len(rows)) - np.repeat(np.cumsum(held) - held, held)
            values = np.full((count, held.max()), np.iinfo(np.uint64).max, dtype=np.uint64)
            places = np.zeros(values.shape, dtype=np.int64)
            values[rows, at], places[rows, at] = order[rows, cols], cols
            low = np.argpartition(values, take - 1, axis=1)[:, :take]
            return np.sort(np.take_along_axis(places, low, axis=1), axis=1)
    return np.sort(np.argpartition(order, take - 1, axis=1)[:, :take], axis=1)


def sketches_of(shingles: np.ndarray, count: int = SKETCHES, picked: int = PICKED) -> np.ndarray:
    """Order MinHash: one 64-bit value a sketch, no two sketches sharing values but by chance."""
    n = len(shingles)
    if not n:
        return np.zeros(0, dtype=np.int64)
    labelled = labelled_of(shingles)
    seeds = _mixed(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x8CB92BA72F3D8DD7))
    take, out, step = min(picked, n), [], max(1, _AT_ONCE // n)
    for a in range(0, count, step):
        some = seeds[a:a + step, None]
        # an order of its own: the product with an odd number keeps mixed values apart
        low = _smallest((labelled[None, :] ^ some) * (some | np.uint64(1)), take) if take < n \
            else np.broadcast_to(np.arange(n), (len(some), n))
        kept = labelled[low]
        value = seeds[a:a + step].copy()
        for i in range(take):
            value = _mixed(value + kept[:, i])
        out.append(value)
    return np.concatenate(out).view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILAR) -> float:
    """L / (a + b - L) of the best alignment, 0 if it is under ``least``.

    Greedy furthest-reaching alignment on the diagonals of the band: at the
    least similarity at most (a + b)(1 - least) / (1 + least) shingles are
    left unaligned, so no path leaves the band.
    """
    total = len(a) + len(b)
    if not len(a) or not len(b):
        return 1.0 if total == 0 else 0.0
    band = int(total * (1 - least) / (1 + least) + 1e-9)
    if abs(len(a) - len(b)) > band:
        return 0.0
    # shingles in common, regardless of order, bound the alignment
    ua, ca = np.unique(a, return_counts=True)
    ub, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    common = int(np.minimum(ca[ia], cb[ib]).sum())
    if total - 2 * common > band:
        return 0.0
    shorter = min(len(a), len(b))
    differs = a[:shorter] != b[:shorter]
    head = int(differs.argmax()) if differs.any() else shorter
    a, b, shorter = a[head:], b[head:], shorter - head
    differs = a[len(a) - shorter:][::-1] != b[len(b) - shorter:][::-1]
    tail = int(differs.argmax()) if differs.any() else shorter
    x, y = a[:len(a) - tail].tolist(), b[:len(b) - tail].tolist()
    nx, ny = len(x), len(y)
    reach, goal, edits = {1: 0}, nx - ny, None
    for d in range(band + 1):
        for k in range(-d, d + 1, 2):
            if k < -ny or k > nx:
                continue
            if k == -d or (k != d and reach.get(k - 1, -1) < reach.get(k + 1, -1)):
                i = reach.get(k + 1, 0)
            else:
                i = reach.get(k - 1, -1) + 1
            j = i - k
            while i < nx and j < ny and x[i] == y[j]:
                i, j = i + 1, j + 1
            reach[k] = i
            if k == goal and i >= nx:
                edits = d
                break
        if edits is not None:
            break
    if edits is None:
        return 0.0
    aligned = (total - edits) // 2
    found = aligned / (total - aligned)
    return found if found >= least - 1e-12 else 0.0


def sketch_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key, words (their digest), the sketches and the number of shingles of every row."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only(_word_hash)
        for batch in batches:
            at = 0
            for part in slices(batch.column(2).to_pylist()):
                nodes, found, lengths = [], [], []
                for text in part:
                    words = _WORD.findall(text.lower())
                    nodes.append(hashlib.md5(" ".join(words).encode("utf-8"), usedforsecurity=False).hexdigest())
                    shingles = shingles_of(words)
                    found.append(sketches_of(shingles))
                    lengths.append(len(shingles))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(part)), batch.column(1).slice(at, len(part)),
                     pa.array(nodes, pa.string()), pa.array(found, pa.list_(pa.int64())),
                     pa.array(lengths, pa.int32())],
                    names=["doc_id", "key", "words", "sketches", "length"])
                at += len(part)

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(F.col(text_col)).alias("key"),
                      F.col(text_col).alias("text"))
    return own.mapInArrow(sketch, "doc_id long, key long, words string, sketches array<long>, length int")


def leading_proposals(shared: DataFrame) -> DataFrame:
    """(a, b): every node with the ``PROPOSALS`` leaders of its buckets that it
    shares most buckets with.  ``shared``: sketch, node, n (members of the bucket)."""
    company = F.sum("n").over(Window.partitionBy("node"))  # at most a row a sketch
    ranked = shared.select("sketch", F.struct(company.alias("company"), F.xxhash64("node").alias("rank"), "node").alias("one"))
    leaders = ranked.groupBy("sketch").agg(F.max("one").alias("lead"))
    met = ranked.join(leaders, "sketch").where(F.col("one.node") != F.col("lead.node")).groupBy(
        F.col("one.node").alias("node")).agg(F.collect_list("lead").alias("leads"))
    agree = F.transform(F.array_distinct("leads"), lambda lead: F.struct(
        F.size(F.filter("leads", lambda other: other == lead)).alias("agree"), lead.alias("lead")))
    best = F.slice(F.sort_array(agree, asc=False), 1, PROPOSALS)
    both = met.select("node", F.explode(best).alias("best"))
    other = F.col("best.lead.node")
    return both.select(F.least("node", other).alias("a"), F.greatest("node", other).alias("b")).distinct()


#: Rows of a shingle outside its largest class that one task joins.
SALTED = 1024
#: Shingles of the exact join handed on at once.
_HANDED_ON = 1 << 18


def _sequence(packed: pa.BinaryScalar) -> np.ndarray:
    """The shingles of one row, without a copy."""
    return np.frombuffer(packed.as_buffer(), dtype=np.uint64)


def rare_prefixes(members: DataFrame, shingles: DataFrame, least: float = SIMILAR) -> DataFrame:
    """node, class, length, place and shingle: the rarest shingles of each text,
    as many as may be left unaligned and one more, without those of one text
    only.  ``members``: node, class."""

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, parts, held = [], [], 0
            for i, (node, packed) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1)), 1):
                parts.append(labelled_of(_sequence(packed)).view(np.int64))
                nodes.append(np.full(len(parts[-1]), node, dtype=np.int64))
                held += len(parts[-1])
                if held >= _HANDED_ON or i == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes)), pa.array(np.concatenate(parts))],
                                                     names=["node", "shingle"])
                    nodes, parts, held = [], [], 0

    with small_batches(members.sparkSession, BATCH_ROWS):
        own = written(shingles.join(members, "node").select("node", "shingles", "class"), "members")
        each = written(own.select("node", "shingles").mapInArrow(labelled, "node long, shingle long"), "labelled")
    common = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("held")).where(F.col("held") > 1)
    listed = each.join(common, "shingle").groupBy("node").agg(F.sort_array(F.collect_list(F.struct(
        "held", "shingle"))).alias("rare"))
    length = (F.length("shingles") / 8).cast("int")
    sized = listed.join(own.select("node", "class", length.alias("length")), "node") \
        .withColumn("single", F.col("length") - F.size("rare"))
    wanted = F.floor(F.col("length") * (1 - least) + 1e-9).cast("int") + 1 - F.col("single")
    return sized.where(wanted > 0).select("node", "class", "length", "single", F.posexplode(
        F.slice("rare", F.lit(1), wanted)).alias("at", "one")).select(
        "node", "class", "length", (F.col("single") + F.col("at")).alias("place"), F.col("one.shingle").alias("shingle"))


def exact_proposals(members: DataFrame, shingles: DataFrame, least: float = SIMILAR) -> DataFrame:
    """(a, b): all pairs of different classes among ``members`` (node, class)
    that can be similar by their rarest shingles, their places and lengths."""
    prefixes = written(rare_prefixes(members, shingles, least), "prefixes")
    # no pair lies inside one class, so the largest class of a shingle is on one side only
    leads = prefixes.groupBy("shingle", "class").agg(F.count(F.lit(1)).alias("n")).groupBy("shingle").agg(
        F.max(F.struct("n", "class")).alias("lead"), F.sum("n").alias("all")).where(F.col("all") > F.col("lead.n")) \
        .select("shingle", F.col("lead.class").alias("lead"),
                F.ceil((F.col("all") - F.col("lead.n")) / SALTED).cast("int").alias("salts"))
    rows = written(prefixes.join(leads, "shingle"), "open-prefixes")
    one = rows.where(F.col("class") != F.col("lead")).select(
        "shingle", F.pmod(F.xxhash64("node"), F.col("salts")).cast("int").alias("salt"), F.col("node").alias("a"),
        F.col("class").alias("class_a"), F.col("length").alias("length_a"), F.col("place").alias("place_a"))
    two = rows.select("shingle", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                      F.col("node").alias("b"), F.col("class").alias("class_b"), F.col("length").alias("length_b"),
                      F.col("place").alias("place_b"), (F.col("class") == F.col("lead")).alias("leads"))
    # the first shingle in common leaves at most the rest of each text to align
    rest = F.least(F.col("length_a") - F.col("place_a"), F.col("length_b") - F.col("place_b"))
    enough = rest >= (F.col("length_a") + F.col("length_b")) * (least / (1 + least)) - 1e-6
    # two texts outside the largest class meet once
    pairs = one.join(two, ["shingle", "salt"]).where(
        (F.col("class_a") != F.col("class_b")) & (F.col("leads") | (F.col("a") < F.col("b"))) & enough)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def shingle_table(texts: DataFrame) -> DataFrame:
    """node and the hashes of its shingles as bytes.  ``texts``: node, text."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_only(_word_hash)
        for batch in batches:
            packed = [shingles_of(_WORD.findall((t.as_py() or "").lower())).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())],
                                             names=["node", "shingles"])

    return texts.select("node", "text").mapInArrow(pack, "node long, shingles binary")


def verified(pairs: DataFrame, shingles: DataFrame, least: float = SIMILAR) -> DataFrame:
    """The pairs whose shingle sequences are similar, as a table."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, left, right = batch.columns
            keep = [similarity(_sequence(x), _sequence(y), least) > 0 for x, y in zip(left, right)]
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], names=["a", "b"])

    one = shingles.select(F.col("node").alias("a"), F.col("shingles").alias("left"))
    two = shingles.select(F.col("node").alias("b"), F.col("shingles").alias("right"))
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right")
    with small_batches(pairs.sparkSession, BATCH_ROWS):
        return written(joined.mapInArrow(align, "a long, b long"), "links")


def components(edges: DataFrame) -> DataFrame:
    """node, class: the smallest node of its component, by hooking to the
    smallest neighbouring class and jumping along classes until nothing changes."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("low")).select(
        F.col("a").alias("node"), F.least("a", "low").alias("class")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("class").alias("near"))
        hooked = labels.join(near, labels["node"] == near["a"]).select(
            "node", F.col("class").alias("old"), F.least("class", "near").alias("class"))
        target = labels.select(F.col("node").alias("class"), F.col("class").alias("far"))
        moved = written(hooked.join(target, "class").select("node", "old", F.least("class", "far").alias("class")),
                        "labels")
        if moved.where(F.col("old") != F.col("class")).isEmpty():
            return moved.select("node", "class")
        labels = moved.select("node", "class")


def merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``classes`` (node, class) after the classes that ``links`` (a, b: nodes) connect became one."""
    of_a, of_b = (classes.select(F.col("node").alias(c), F.col("class").alias(f"class_{c}")) for c in "ab")
    between = links.join(of_a, "a").join(of_b, "b").where(F.col("class_a") != F.col("class_b")).select(
        F.col("class_a").alias("a"), F.col("class_b").alias("b"))
    into = components(between).select(F.col("node").alias("class"), F.col("class").alias("into"))
    return written(classes.join(into, "class", "left").select("node", F.coalesce("into", "class").alias("class")),
                   "classes")


def still_apart(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """a, b, class_a and class_b of the pairs between different classes."""
    of_a, of_b = (classes.select(F.col("node").alias(c), F.col("class").alias(f"class_{c}")) for c in "ab")
    return pairs.join(of_a, "a").join(of_b, "b").where(F.col("class_a") != F.col("class_b"))


def one_a_class(pairs: DataFrame) -> DataFrame:
    """(a, b): for every node one partner in each other class.  ``pairs``: a, b, class_a, class_b."""
    ends = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.col("class_b").alias("other"), F.col("b").alias("partner")),
        F.struct(F.col("b").alias("node"), F.col("class_a").alias("other"), F.col("a").alias("partner")))).alias("e"))
    chosen = ends.groupBy("e.node", "e.other").agg(F.min(F.struct(
        F.xxhash64("e.partner").alias("rank"), F.col("e.partner").alias("partner"))).alias("of"))
    return chosen.select(F.least("node", "of.partner").alias("a"), F.greatest("node", "of.partner").alias("b")).distinct()


def duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key and class (a number) of every row."""
    spark = docs.sparkSession
    with small_batches(spark, BATCH_ROWS):
        rows = written(sketch_table(docs, id_col, text_col), "sketches")
    # equal words have equal sketches; a node stands for them, and one row of them holds its text
    who = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("who")
    nodes = written(rows.groupBy("words").agg(
        F.min(F.struct(who, "key")).alias("of"), F.first("sketches").alias("sketches"), F.first("length").alias("length"))
        .select("words", F.monotonically_increasing_id().alias("node"), "of.who", "of.key", "sketches", "length"), "nodes")
    exploded = nodes.select("node", F.explode("sketches").alias("sketch"))
    sizes = exploded.groupBy("sketch").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    shared = written(exploded.join(sizes, "sketch"), "shared")
    # similar texts differ in length by this factor at most
    short = nodes.where(F.col("length") <= int(SHORT / SIMILAR + 1e-9)).select("node")
    # no other node can have a partner
    wanted = written(shared.select("node").union(short).distinct(), "wanted")
    holders = nodes.select("node", "who", "key").join(wanted, "node")
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), row_key(F.col(text_col)).alias("key"),
                      F.col(text_col).alias("text")).select(who, "key", "text")
    # repeated rows hold the same text, of which one copy is enough
    held = own.join(holders, ["key", "who"]).groupBy("key", "who").agg(
        F.first("node").alias("node"), F.first("text").alias("text"))
    with small_batches(spark, BATCH_ROWS):
        shingles = written(shingle_table(held), "shingles")

    links = verified(leading_proposals(shared), shingles)
    classes = written(wanted.join(components(links), "node", "left").select(
        "node", F.coalesce("class", "node").alias("class")), "classes")
    placed = shared.select("sketch", "node").join(classes, "node")
    mixed = placed.groupBy("sketch").agg(F.min("class").alias("low"), F.max("class").alias("high")) \
        .where(F.col("low") != F.col("high")).select("sketch")
    apart = placed.join(mixed, "sketch").select("node").union(short).distinct()
    pairs = written(exact_proposals(written(classes.join(apart, "node"), "apart"), shingles), "pairs")
    # most pairs lie between two classes that one of them joins
    for chosen in (one_a_class, lambda rest: rest.select("a", "b")):
        links = verified(chosen(still_apart(pairs, classes)), shingles)
        classes = merged(classes, links)
    named = nodes.select("words", "node").join(classes, "node", "left").select(
        "words", F.coalesce("class", "node").alias("class"))
    return rows.select("doc_id", "key", "words").join(named, "words").select("doc_id", "key", "class")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class), class_size and representative, a row per input row."""
    rows = written(duplicate_classes(docs, id_col, text_col), "classes")
    named = rows.groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return rows.join(named, "class").select("doc_id", "class_id", "class_size",
                                            same(F.col("doc_id"), F.col("class_id")).alias("representative"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, any other columns) with one row of each class:
    that of the smallest doc_id, null ids last; equal rows count once."""
    rows = written(duplicate_classes(docs), "classes")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first")
    kept = rows.groupBy("class").agg(first).select(F.col("first.doc_id").alias("kept_id"),
                                                   F.col("first.key").alias("kept_key"))
    match = (row_key(docs["text"]) == kept["kept_key"]) & same(docs["doc_id"], kept["kept_id"])
    # rows that agree in doc_id and text are one document
    mark = "one_of_equal_rows"
    while mark in docs.columns:
        mark += "_"
    alone = docs.join(kept, match, "left_semi").withColumn(mark, row_key(F.col("text")))
    return alone.dropDuplicates(["doc_id", mark]).drop(mark)
