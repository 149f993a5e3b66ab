"""Hard-negative mining by cover trees over norm-augmented vectors.

Whole-number vectors v get one more coordinate, sqrt(M^2 - |v|^2) with M the
largest length in their tree, and an anchor q gets 0 there.  All augmented
vectors have length M, so |q - v|^2 = |q|^2 + M^2 - 2 q.v, and a ball around c
with radius r bounds the inner products of all it covers:

    (|q|^2 + M^2 - (d + r)^2) / 2 <= q.v <= (|q|^2 + M^2 - max(0, d - r)^2) / 2,   d = |q - c|.

Vectors are dealt out to blocks of one label, near the same of ``PIVOTS`` pivots
(farthest points of a bounded sample; they shape the blocks, not the results) and
about ``BLOCK`` rows each, however many rows a label or a pivot has.  A block is
one cover tree: level by level the balls shrink by ``SHRINK``, children are
farther apart than their own radius, and the true radius over all descendants
is kept.  Anchors meet the trees in packs.  Best-first descent, from the root
on, takes the node with the highest bound, skips nodes outside all windows or
below the results found, and scores leaves exactly in 64-bit whole numbers.
The best of all trees are merged by rank.

First the trees of an anchor's own label give its positives; each positive sets
a window of scores, and the trees of the other labels give the negatives.

Defined cases: rows with a null id, label or vector, or a null or non-finite
component, or one of 2^18 or more in size (its scores may not fit 64 bits) take
no part; shorter vectors end in zeros; an empty vector scores 0.  Repeated rows
(id, label and vector) count once; rows that share an id only are rows of their
own, ordered by a hash of their content.  An anchor without positives, or a
window without rows, gives no rows; an empty table gives none.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerlens.llm.native import small_batches, written

#: Rows of a block (one tree) expected; anchors of a pack.
BLOCK = 2_048
PACK = 1_024
#: Bounds of the pivots and of the sample they come from.
PIVOTS = 64
SAMPLE = 4_096
SHRINK = 1.6
LEAF = 32
POSITIVES = 5
NEGATIVES = 5
SCALE = 256
_SIZE = float(1 << 26)


# -- one tree ----------------------------------------------------------------

class Tree:
    """A cover tree over the rows of ``vectors`` (64-bit whole numbers).

    Node i covers the rows ``order[start[i]:stop[i]]``; its centre is the first
    of them; its children are the nodes ``child[i]`` to ``child[i] + children[i]``.
    """

    def __init__(self, vectors: np.ndarray):
        sizes = (vectors * vectors).sum(axis=1)
        self.most = int(sizes.max()) if len(sizes) else 0
        exact = np.concatenate((vectors.astype(np.float64), np.sqrt((self.most - sizes).astype(np.float64))[:, None]), axis=1)
        start, stop, radius, child, children = [0], [len(vectors)], [0.0], [0], [0]
        self.order = np.arange(len(vectors))
        todo = [0] if len(vectors) else []
        while todo:
            i = todo.pop()
            a, b = start[i], stop[i]
            rows = self.order[a:b]
            far = self._from(exact, rows, rows[0])
            radius[i] = float(far.max())
            if b - a <= LEAF or radius[i] == 0.0:
                continue
            # centres of the next level: the farthest row until every row is covered
            cover, nearest, owner, centres = radius[i] / SHRINK, far, np.zeros(b - a, dtype=np.int64), [0]
            while True:
                next_ = int(nearest.argmax())
                if nearest[next_] <= cover:
                    break
                own = self._from(exact, rows, rows[next_])
                closer = own < nearest
                nearest, owner = np.where(closer, own, nearest), np.where(closer, len(centres), owner)
                owner[next_] = len(centres)
                centres.append(next_)
            # a child's rows follow each other, its centre first
            not_centre = np.ones(b - a, dtype=np.int8)
            not_centre[centres] = 0
            by = np.lexsort((not_centre, owner))
            self.order[a:b] = rows[by]
            held = np.bincount(owner, minlength=len(centres))
            child[i], children[i] = len(start), len(centres)
            ends = a + np.cumsum(held)
            for first, last in zip((ends - held).tolist(), ends.tolist()):
                todo.append(len(start))
                start.append(first)
                stop.append(last)
                radius.append(0.0)
                child.append(0)
                children.append(0)
        self.start, self.stop = np.array(start), np.array(stop)
        # rounding must never make a ball too small
        self.radius = np.array(radius) * (1 + 1e-9) + 1e-6
        self.child, self.children = np.array(child), np.array(children)
        self.sorted = vectors[self.order]

    #: What is stored of a tree, with the types.
    FIELDS = (("order", "<i8"), ("start", "<i8"), ("stop", "<i8"), ("radius", "<f8"), ("child", "<i8"),
              ("children", "<i8"), ("sorted", "<i4"))

    def stored(self) -> list[bytes]:
        return [getattr(self, name).astype(kind).tobytes() for name, kind in self.FIELDS]

    @classmethod
    def loaded(cls, cells: list[bytes]) -> Tree:
        tree = cls.__new__(cls)
        for (name, kind), cell in zip(cls.FIELDS, cells):
            setattr(tree, name, np.frombuffer(cell, dtype=kind))
        tree.sorted = tree.sorted.astype(np.int64).reshape(len(tree.order), -1)
        tree.most = int((tree.sorted * tree.sorted).sum(axis=1).max())
        return tree

    @staticmethod
    def _from(exact: np.ndarray, rows: np.ndarray, centre: int) -> np.ndarray:
        gap = exact[rows] - exact[centre]
        return np.sqrt(np.einsum("ij,ij->i", gap, gap))

    def bounds(self, q: np.ndarray, nodes: slice) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product with q inside each node."""
        dots = self.sorted[self.start[nodes]] @ q
        both = float(int((q * q).sum()) + self.most)
        d, r = np.sqrt(np.maximum(0.0, both - 2.0 * dots)), self.radius[nodes]
        slack = 1e-6 * (1.0 + both)
        return (both - (d + r) ** 2) / 2 - slack, (both - np.maximum(0.0, d - r) ** 2) / 2 + slack

    def search(self, q: np.ndarray, windows: list[tuple[int, int]], rank: np.ndarray, count: int,
               skip: int = -1) -> list[list[tuple[int, int]]]:
        """Per window [low, high] the best ``count`` (score, row) by descending
        score, then ``rank``.  ``skip`` is a row that takes no part."""
        best: list[list[tuple[int, int, int]]] = [[] for _ in windows]
        if not len(self.start) or not self.stop[0]:
            return [[] for _ in windows]
        lows, highs = (np.array(x, dtype=np.float64) for x in zip(*windows))
        #: a node is of use to a window if it may hold scores in it above the last result kept
        least = lows.copy()

        def open_(low: float, high: float) -> bool:
            return bool(((high >= least) & (low <= highs)).any())

        def offer(places: np.ndarray) -> None:
            rows, scores = self.order[places], self.sorted[places] @ q
            for w, (low, high) in enumerate(windows):
                fit = (scores >= max(low, int(least[w]))) & (scores <= high) & (rows != skip)
                if not fit.any():
                    continue
                found = sorted(best[w] + [(-int(s), int(rank[r]), int(r)) for s, r in zip(scores[fit], rows[fit])])[:count]
                best[w] = found
                if len(found) == count:
                    # equal scores may still win by rank
                    least[w] = max(lows[w], -found[-1][0])

        low, high = self.bounds(q, slice(0, 1))
        heap = [(-high[0], 0, low[0])]
        while heap:
            above, node, below = heapq.heappop(heap)
            if not open_(below, -above):
                # windows differ, so nodes of lower bounds may still be of use
                continue
            if not self.children[node]:
                offer(np.arange(self.start[node], self.stop[node]))
                continue
            nodes = slice(self.child[node], self.child[node] + self.children[node])
            low, high = self.bounds(q, nodes)
            alone = self.stop[nodes] - self.start[nodes] <= 4
            use = ((high[:, None] >= least) & (low[:, None] <= highs)).any(axis=1)
            small = np.flatnonzero(alone & use)
            if len(small):
                first, last = self.start[nodes][small], self.stop[nodes][small]
                offer(np.concatenate([np.arange(x, y) for x, y in zip(first, last)]))
            for i in np.flatnonzero(use & ~alone):
                heapq.heappush(heap, (-high[i], int(self.child[node] + i), low[i]))
        return [[(-s, r) for s, _, r in found] for found in best]


# -- blocks and packs ----------------------------------------------------------

def _matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of whole numbers of one list column, short ones ending in zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(column.offsets.to_numpy()).astype(np.int64)
    width = max(int(sizes.max()) if len(sizes) else 0, width or 0, 1)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def candidates(embeddings: DataFrame, id_col: str, vector_col: str, label: Column) -> DataFrame:
    """vec_id, label, vec (whole numbers) and tag (hash of the content) of the rows that take part."""
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                             F.col(vector_col).cast("array<double>").alias("raw"))
    fit = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < _SIZE / SCALE))
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("raw").isNotNull() & fit)
    whole = kept.select("vec_id", "label", F.transform("raw", lambda x: F.floor(x * SCALE).cast("int")).alias("vec"))
    return whole.withColumn("tag", F.xxhash64("label", "vec")).dropDuplicates(["vec_id", "label", "tag"])


def pivots_of(rows: DataFrame, blocks: int) -> np.ndarray:
    """Farthest points, as many as there are blocks but at most ``PIVOTS``, of a
    sample of about ``SAMPLE`` rows chosen by hash."""
    total = rows.count()
    slots = 1 << 30
    share = min(slots, slots * SAMPLE // max(1, total) + 1)
    picked = rows.where(F.pmod(F.xxhash64("vec_id", "tag"), F.lit(slots)) < share).select("vec").limit(2 * SAMPLE)
    sample = [r.vec for r in picked.collect()]
    width = max((len(v) for v in sample), default=1) or 1
    points = np.array([v + [0] * (width - len(v)) for v in sample], dtype=np.float64).reshape(len(sample), width)
    points = points[np.lexsort(points.T)] if len(points) else np.zeros((1, width))
    chosen, far = [0], ((points - points[0]) ** 2).sum(axis=1)
    while len(chosen) < min(blocks, PIVOTS, len(points)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((points - points[chosen[-1]]) ** 2).sum(axis=1))
    return points[chosen]


_PLACED = "vec_id long, label long, vec array<int>, tag long, pivot int"


def placed(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``rows`` with the nearest pivot."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _matrix(batch.column(2), pivots.shape[1]).astype(np.float64)
            wide = np.zeros((len(pivots), own.shape[1]))
            wide[:, :pivots.shape[1]] = pivots
            gap = (wide ** 2).sum(axis=1) - 2 * own @ wide.T
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(gap.argmin(axis=1).astype(np.int32))],
                                             names=[*batch.schema.names, "pivot"])

    return rows.mapInArrow(nearest, _PLACED)


def packed(rows: DataFrame, by: str | None, size: int, *cells: str) -> DataFrame:
    """A row for about ``size`` rows, which agree in ``by``: ``cells`` as arrays.  A
    larger group is dealt out by hash, so no list grows with the table."""
    if by is None:
        parts = -(-rows.count() // size)
        dealt = rows.withColumn("part", F.pmod(F.xxhash64("tag", "vec_id"), F.lit(max(1, parts))).cast("int"))
    else:
        parts = rows.groupBy(by).agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("parts"))
        dealt = rows.join(parts, by).withColumn("part", F.pmod(F.xxhash64("tag", "vec_id"), F.col("parts")).cast("int"))
    key = [by, "part"] if by else ["part"]
    grouped = dealt.groupBy(*key).agg(F.collect_list(F.struct(*cells)).alias("all"))
    return grouped.select(*key, *(F.col(f"all.{c}").alias(c) for c in cells))


_TREE = ", ".join(f"tree_{name} binary" for name, _ in Tree.FIELDS)


def tree_blocks(rows: DataFrame) -> DataFrame:
    """label, vec_id and tag of the rows of each block, and its cover tree."""
    schema = f"label long, vec_id array<long>, tag array<long>, {_TREE}"
    names = [c.split()[0] for c in schema.split(", ")]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = dict(zip(batch.schema.names, batch.columns))
            for i in range(batch.num_rows):
                tree = Tree(_matrix(cells["vec"][i].values)).stored()
                yield pa.RecordBatch.from_arrays(
                    [cells[n].slice(i, 1) for n in names[:3]] + [pa.array([t], pa.binary()) for t in tree], names=names)

    group = rows.withColumn("group", F.struct("label", "pivot"))
    blocks = packed(group, "group", BLOCK, "vec_id", "tag", "vec").select(
        F.col("group.label").alias("label"), "vec_id", "tag", "vec")
    with small_batches(rows.sparkSession, 8):
        return written(blocks.mapInArrow(build, schema), "trees")


_FOUND = "anchor_id long, anchor_tag long, window_id long, window_tag long, window_score long, vec_id long, tag long, score long"
_WINDOWS = ("window_id", "window_tag", "window_score", "low", "high")


def searched(packs: DataFrame, trees: DataFrame, own_label: bool, count: int) -> DataFrame:
    """The best ``count`` rows of every tree for each window of each anchor.

    ``packs``: anchor_id, anchor_tag, label, a_vec and the windows as arrays of
    the pack.  With ``own_label`` packs and trees of one label meet.  Otherwise
    every pack meets every tree - a stated query set against all rows, in
    blocks - and anchors of the tree's label pass it by."""
    names = [c.split()[0] for c in _FOUND.split(", ")]
    stored = [c.split()[0] for c in _TREE.split(", ")]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = dict(zip(batch.schema.names, batch.columns))
            for i in range(batch.num_rows):
                tree, out = Tree.loaded([at[n][i].as_buffer() for n in stored]), []
                ids, tags = (at[n][i].values.to_numpy() for n in ("vec_id", "tag"))
                rank = np.empty(len(ids), dtype=np.int64)
                rank[np.lexsort((tags, ids))] = np.arange(len(ids))
                width = tree.sorted.shape[1]
                anchors = _matrix(at["a_vec"][i].values, width)
                if anchors.shape[1] > width:
                    tree.sorted = np.pad(tree.sorted, ((0, 0), (0, anchors.shape[1] - width)))
                a_ids, a_tags, labels = (at[n][i].values.to_numpy() for n in ("anchor_id", "anchor_tag", "label"))
                told = zip(*(at[n][i].as_py() for n in _WINDOWS))
                for k, (w_id, w_tag, w_score, low, high) in enumerate(told):
                    if not own_label and labels[k] == at["tree_label"][i].as_py():
                        continue
                    itself = np.flatnonzero((ids == a_ids[k]) & (tags == a_tags[k])) if own_label else ()
                    found = tree.search(anchors[k], list(zip(low, high)), rank, count,
                                        int(itself[0]) if len(itself) else -1)
                    for w, hits in enumerate(found):
                        out += [(a_ids[k], a_tags[k], w_id[w], w_tag[w], w_score[w], ids[r], tags[r], score)
                                for score, r in hits]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)

    trees = trees.withColumnRenamed("label", "tree_label")
    if own_label:
        met = packs.join(trees, F.element_at("label", 1) == F.col("tree_label"))
    else:
        last = packs.agg(F.max("part")).first()[0]
        met = packs.join(trees.select("*", F.explode(F.sequence(F.lit(0), F.lit(last or 0))).alias("part")), "part")
    spark = packs.sparkSession
    # few but costly rows: dealt out one by one, whatever their bytes
    dealt = met.select("anchor_id", "anchor_tag", "label", "a_vec", *_WINDOWS, "tree_label", "vec_id", "tag", *stored) \
        .repartition(4 * spark.sparkContext.defaultParallelism)
    with small_batches(spark, 8):
        return written(dealt.mapInArrow(search, _FOUND), "found")


def top(found: DataFrame, by: list[str], count: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), "vec_id", "tag")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def hard_negatives(embeddings: DataFrame, is_anchor: Column, label: Column, id_col: str = "vec_id",
                   vector_col: str = "embedding", least: int = 80, most: int = 100, positives: int = POSITIVES,
                   negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score:
    per anchor its best ``positives`` rows of the same label, and per positive
    the best ``negatives`` rows of another label whose score is ``least`` to
    ``most`` percent of the positive's.  ``is_anchor`` reads vec_id, ``label`` the table."""
    rows = written(candidates(embeddings, id_col, vector_col, label), "vectors")
    total = rows.count()
    pivots = pivots_of(rows, -(-total // BLOCK))
    with small_batches(embeddings.sparkSession, 4_096):
        dealt = written(placed(rows, pivots), "placed")
    trees = tree_blocks(dealt)
    anchors = written(rows.where(is_anchor).select(
        F.col("vec_id").alias("anchor_id"), F.col("tag").alias("anchor_tag"), "label", F.col("vec").alias("a_vec")), "anchors")
    every = F.lit(1 << 62)

    def packs_of(told: DataFrame, by: str | None) -> DataFrame:
        own = told.withColumn("vec_id", F.col("anchor_id")).withColumn("tag", F.col("anchor_tag")) \
            .withColumn("group", F.col("label"))
        return written(packed(own, by, PACK, "anchor_id", "anchor_tag", "label", *_WINDOWS, "a_vec"), "packs")

    none = F.lit(0).cast("long")
    first = anchors.select("*", *(F.array(c).alias(n) for n, c in zip(_WINDOWS, (none, none, none, -every, every))))
    near = top(searched(packs_of(first, "group"), trees, True, positives), ["anchor_id", "anchor_tag"], positives)
    positive = written(near.select("anchor_id", "anchor_tag", F.col("vec_id").alias("positive_id"),
                                   F.col("tag").alias("positive_tag"), F.col("score").alias("positive_score")), "positives")
    # whole scores s with least * p <= 100 s <= most * p
    low, high = (F.expr(x).cast("long") for x in (
        f"({least} * positive_score + pmod(-({least} * positive_score), 100)) div 100",
        f"({most} * positive_score - pmod({most} * positive_score, 100)) div 100"))
    windows = positive.withColumn("low", low).withColumn("high", high).where(F.col("low") <= F.col("high")) \
        .groupBy("anchor_id", "anchor_tag").agg(F.collect_list(F.struct(
            F.col("positive_id").alias("window_id"), F.col("positive_tag").alias("window_tag"),
            F.col("positive_score").alias("window_score"), "low", "high")).alias("all"))
    second = anchors.join(windows, ["anchor_id", "anchor_tag"]).select(
        "anchor_id", "anchor_tag", "label", "a_vec",
        *(F.col(f"all.{n}").alias(n) for n in _WINDOWS))
    hard = top(searched(packs_of(second, None), trees, False, negatives),
               ["anchor_id", "anchor_tag", "window_id", "window_tag"], negatives)
    return hard.select("anchor_id", F.col("window_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                       F.col("vec_id").alias("negative_id"), F.col("window_score").alias("positive_score"),
                       F.col("score").alias("negative_score"))
