"""Reconciliation by a tree of digests.

Every row falls into a leaf by a hash of its key.  A leaf's digest does not
depend on the order of its rows: their number, and the exclusive or and the sum
of 64-bit hashes of whole rows.  Leaves add up to branches and these to the
root, so two runs are compared from the root down, and only rows of leaves that
differ are joined.  Rows are digested where they lie; what is shuffled is at
most a row a leaf and task, and for equal runs nothing else.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Leaves of the tree and leaves of a branch: bounds of what is broadcast.
LEAVES = 4_096
FANOUT = 64


def leaf_of(keys: Sequence[str], leaves: int = LEAVES) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(leaves)).cast("int")


def _summed(rows: DataFrame, level: str, count: Column, mixed: Column, total: Column) -> DataFrame:
    return rows.groupBy(level).agg(F.sum(count).alias("row_count"), F.bit_xor(mixed).alias("mixed"),
                                   F.sum(total).alias("total"))


def leaf_digests(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], leaves: int = LEAVES) -> DataFrame:
    """leaf, row_count, mixed and total of every leaf with rows.  A null differs
    from every value, and repeated rows count as often as they occur."""
    # xxhash64 passes over nulls, so each column says whether it is one
    whole = F.xxhash64(*(x for c in columns for x in (F.col(c).isNull(), F.col(c))))
    own = rows.select(leaf_of(keys, leaves).alias("leaf"), whole.alias("h"))
    # the sum cannot overflow: at most 2^63 rows of 64 bits in 38 digits
    return _summed(own, "leaf", F.lit(1), F.col("h"), F.col("h").cast("decimal(19,0)"))


def rolled_up(digests: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """The next level of the tree."""
    up = digests.withColumn("leaf", F.floor(F.col("leaf") / fanout).cast("int"))
    return _summed(up, "leaf", F.col("row_count"), F.col("mixed"), F.col("total")) \
        .withColumn("total", F.col("total").cast("decimal(38,0)"))


def differing(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """``leaf`` of the nodes of one level whose digests differ."""
    same = reduce(lambda x, y: x & y, (F.col(f"b.{c}").eqNullSafe(F.col(f"c.{c}")) for c in ("row_count", "mixed", "total")))
    joined = baseline.alias("b").join(current.alias("c"), F.col("b.leaf") == F.col("c.leaf"), "full_outer")
    return joined.where(~same).select(F.coalesce("b.leaf", "c.leaf").alias("leaf"))


def differing_leaves(baseline: DataFrame, current: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Leaves that differ, below branches that differ.  Both: leaf digests."""
    branches = differing(rolled_up(baseline, fanout), rolled_up(current, fanout)).withColumnRenamed("leaf", "branch")

    def below(leaves: DataFrame) -> DataFrame:
        branch = F.floor(F.col("leaf") / fanout).cast("int")
        return leaves.join(F.broadcast(branches), branch == F.col("branch"), "left_semi")

    return differing(below(baseline), below(current))


def one_sided(baseline: DataFrame, current: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None,
              leaves: int = LEAVES) -> DataFrame:
    """Rows of ``columns`` whose key only one run holds, with ``row_status``
    (MISSING: in the baseline only, EXTRA: in the current run only).  Keys are
    compared null-safely.  Only leaves whose keys differ are joined."""
    shown = list(columns or keys)
    sides = [leaf_digests(side, keys, keys, leaves) for side in (baseline, current)]
    open_leaves = F.broadcast(differing_leaves(*sides))  # at most ``leaves`` numbers

    def part(side: DataFrame) -> DataFrame:
        return side.select(*dict.fromkeys([*keys, *shown]), leaf_of(keys, leaves).alias("leaf")).join(
            open_leaves, "leaf", "left_semi")

    b, c = part(baseline), part(current)
    alike = reduce(lambda x, y: x & y, (F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys))

    def only(left: DataFrame, right: DataFrame, status: str) -> DataFrame:
        return left.alias("l").join(right.alias("r"), (F.col("l.leaf") == F.col("r.leaf")) & alike, "left_anti") \
            .select(*shown, F.lit(status).alias("row_status"))

    return only(b, c, "MISSING").unionByName(only(c, b, "EXTRA"))
