"""Exact distinct counts that can be merged (A3, Q12, K1).

Every key gets a lasting number within its bucket.  The keys of a group are
then bitmaps of these numbers: a state holds ``bits`` for one ``chunk`` (32,768
numbers) of one ``bucket``.  States of groups are merged by OR, so a count over
several dates or groups needs their states only, never the rows again.

Numbers are dense within a bucket; a state takes 4 KiB however few of its
numbers a group holds, so buckets are to hold tens of thousands of keys.

Keys with a null in any column are not counted, as in ``COUNT(DISTINCT ...)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import BucketedTable, stored

#: Where a state belongs among the numbers.
PLACE = ("bucket", "chunk")
NUMBER = "number"


class KeyNumbers:
    """A bucketed table of keys and their numbers, from 1 in every bucket."""

    def __init__(self, spark: SparkSession, base: str, keys: Sequence[str], buckets: int = 16):
        self.table = BucketedTable(spark, base, keys, buckets)
        self.keys = list(keys)

    def unique(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.keys).dropna().distinct()

    def _numbered(self, keys: DataFrame, after: Column) -> DataFrame:
        """Numbers in key order, so a task that runs twice gives the same."""
        w = Window.partitionBy(self.table.bucket()).orderBy(*self.keys)
        return keys.select(*self.keys, (after + F.row_number().over(w)).cast("long").alias(NUMBER))

    def extend(self, rows: DataFrame) -> int:
        """Numbers the keys of ``rows`` that have none yet and returns how many.
        Of two loads that number keys of one bucket at once, one is refused."""
        read = self.table.current()
        if read is None:
            self.table.load(self._numbered(self.unique(rows), F.lit(0)))
            return self.table.read().count()
        held = self.table.read(read)
        # a row a bucket
        tops = held.groupBy(self.table.bucket().alias("_b")).agg(F.max(NUMBER).alias("_top"))
        new = self.table.aligned(self.unique(rows)).join(held, self.keys, "left_anti")
        new = new.join(F.broadcast(tops), self.table.bucket() == F.col("_b"), "left")
        fresh = stored(self._numbered(new, F.coalesce(F.col("_top"), F.lit(0))), "key-numbers")
        return self.table.upsert(fresh, {NUMBER: 0}, [NUMBER], read=read)["INSERT"]

    def of(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the number of their key; the number table stays where it lies."""
        return self.table.aligned(rows).join(self.table.read(), self.keys)


def states(rows: DataFrame, groups: Sequence[str], numbers: KeyNumbers) -> DataFrame:
    """A state per group, bucket and chunk.  A key goes once a group to its bucket."""
    pairs = rows.select(*groups, *(F.col(k).alias(f"_{k}") for k in numbers.keys)).dropna(
        subset=[f"_{k}" for k in numbers.keys]).distinct()
    keyed = numbers.of(pairs.select(*(F.col(g).alias(f"g_{g}") for g in groups),
                                    *(F.col(f"_{k}").alias(k) for k in numbers.keys)))
    return keyed.groupBy(*(F.col(f"g_{g}").alias(g) for g in groups),
                         numbers.table.bucket().cast("int").alias("bucket"),
                         F.bitmap_bucket_number(NUMBER).alias("chunk")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(NUMBER)).alias("bits"))


def merged_bits() -> Column:
    """The aggregate that merges states of one place."""
    return F.bitmap_or_agg("bits").alias("bits")


def held() -> Column:
    """Keys in a state."""
    return F.bitmap_count("bits")
