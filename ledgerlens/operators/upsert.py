"""Keyed conditional upsert without a table format.

``upsert`` is a single full outer join of target and source on the key that
labels every key with an action:

* ``INSERT``  — key only in the source
* ``UPDATE``  — key on both sides and the change predicate is true
* ``NOOP``    — key on both sides, nothing relevant changed
* ``DELETE``  — key only in the target and ``delete_unmatched`` (stale rows)
* ``KEEP``    — key only in the target otherwise

The merged table is every row whose action is not DELETE; the metrics are a
group-by on the action.  Keys are unique on each side (a primary key and a
source that is de-duplicated or checked, see ``unique_source``), so the join
has no skew to split.  The caller writes
the merged frame to a new location and switches to it (see ``sinks``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expressions import changed

ACTION = "_action"
HASH = "_key_hash"


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           change_columns: Mapping[str, object], update_columns: Sequence[str],
           delete_unmatched: bool = False, null_safe_keys: bool = False,
           null_safe_change: bool = False, unique_source: bool = False, beside: str | None = None) -> DataFrame:
    """Return target columns + ``_action`` for every key of either side.

    A source key that occurs twice would match a target row twice, which MERGE
    refuses.  With ``unique_source`` the plan itself refuses it: a second source
    row of a key raises when the frame runs (no separate pass over the source).

    Null-safe keys are joined by a 64-bit hash of them, and rows with equal
    hashes are then compared key by key: sides that are already shuffled by that
    hash are not shuffled again, and the sort is one of numbers.  Other keys may
    be joined the same way ``beside`` a column of both sides that is equal where
    the keys are equal; it is not part of the result.

    ``change_columns`` maps column -> default used in ``COALESCE(t.c, d) <>
    COALESCE(s.c, d)`` (P9/D21); ``update_columns`` are copied from the source
    on UPDATE, every other column keeps the target value (so e.g.
    ``created_date`` survives updates).  INSERT takes every column the source
    has."""
    hashed = [F.xxhash64(*keys).alias(HASH)] if null_safe_keys else []
    t = target.select(*[F.col(c) for c in target.columns], F.lit(True).alias("_t_present"), *hashed).alias("t")
    s = source.select(*[F.col(c) for c in source.columns], F.lit(True).alias("_s_present"), *hashed)
    if unique_source:
        s = _alone(_hashed_rows(s, keys) if null_safe_keys else _grouped_rows(s, keys), s.columns, keys)
    s = s.alias("s")
    if null_safe_keys or beside is not None:
        # a count of equal keys, which no plan takes apart into further join keys
        same = Column.eqNullSafe if null_safe_keys else Column.__eq__
        alike = reduce(lambda x, y: x + y, (F.when(same(F.col(f"t.{k}"), F.col(f"s.{k}")), 1).otherwise(0)
                                            for k in keys))
        near = beside or HASH
        cond = (F.col(f"t.{near}") == F.col(f"s.{near}")) & (alike == len(keys))
    else:
        # the last key first: dates, which most rows share, are no help to a sort
        cond = reduce(lambda x, y: x & y, (F.col(f"t.{k}") == F.col(f"s.{k}") for k in reversed(keys)))
    j = t.join(s, cond, "full_outer")
    in_t = F.col("t._t_present").isNotNull()
    in_s = F.col("s._s_present").isNotNull()
    diff = changed("t", "s", change_columns, null_safe=null_safe_change)
    action = (F.when(in_s & ~in_t, F.lit("INSERT"))
               .when(in_s & in_t & diff, F.lit("UPDATE"))
               .when(in_s & in_t, F.lit("NOOP"))
               .otherwise(F.lit("DELETE" if delete_unmatched else "KEEP")))
    j = j.withColumn(ACTION, action)

    def out(c: str) -> Column:
        tc = F.col(f"t.{c}")
        if c in keys:
            return F.when(in_t, tc).otherwise(F.col(f"s.{c}")).alias(c)
        sc = F.col(f"s.{c}") if c in source.columns else F.lit(None).cast(target.schema[c].dataType)
        a = F.col(ACTION)
        if c in update_columns:
            return F.when(a.isin("INSERT", "UPDATE"), sc).otherwise(tc).alias(c)
        return F.when(a == "INSERT", sc).otherwise(tc).alias(c)

    return j.select(*[out(c) for c in target.columns if c != beside], F.col(ACTION))


def _hashed_rows(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source shuffled and sorted by the hash of its keys; ``_n`` is above 1 on a key's later rows."""
    w = Window.partitionBy(HASH, *keys).orderBy(HASH)
    return source.repartition(HASH).withColumn("_n", F.lag(F.lit(2), 1, 1).over(w))


def _grouped_rows(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A row of the source per key, grouped where it lies if it is partitioned by key; ``_n`` counts its rows."""
    rest = [c for c in source.columns if c not in keys]
    return source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *(F.any_value(c).alias(c) for c in rest))


def _alone(counted: DataFrame, columns: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """``columns`` of the rows; running it raises where a key has more than one."""
    refused = F.raise_error(F.concat(
        F.lit(f"upsert source: duplicate key {list(keys)}: "),
        F.concat_ws(", ", *(F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys)))).cast("boolean")
    # a condition on the rows, not a column: no plan can leave it out, and the
    # order of the rows still serves the join
    return counted.where(F.when(F.col("_n") > 1, refused).otherwise(F.lit(True))).select(*columns)


def merged(result: DataFrame) -> DataFrame:
    """The table after the upsert (everything but DELETE)."""
    return result.filter(F.col(ACTION) != "DELETE").drop(ACTION)


def action_metrics(result: DataFrame) -> DataFrame:
    """Rows per action (what the table history reports after a MERGE)."""
    return result.groupBy(F.col(ACTION).alias("action")).agg(F.count(F.lit(1)).alias("row_count"))


def delete_stale(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep only target rows whose key is in the source (semi join, no
    driver-side key list)."""
    return target.join(source.select(*keys).distinct(), list(keys), "left_semi")


def replace_date(table: DataFrame, new_rows: DataFrame, business_date, date_col: str = "business_date") -> DataFrame:
    """The table with one date's rows replaced by ``new_rows`` — also when
    ``new_rows`` is empty, where a dynamic partition overwrite would leave the
    old rows in place."""
    d = F.lit(business_date) if not isinstance(business_date, Column) else business_date
    return table.filter(~F.col(date_col).eqNullSafe(d)).unionByName(new_rows.select(*table.columns))


def accumulate(table: DataFrame, new_rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """D13 ``accumulate`` mode: history is kept, new keys appended, existing
    keys refreshed from the new rows."""
    return table.join(new_rows.select(*key), list(key), "left_anti").unionByName(
        new_rows.select(*table.columns))


# --- key checks (actions; run them on bounded config or as an explicit gate) --

def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once (lazy; partial aggregation)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "frame") -> None:
    """Raise if ``keys`` is not unique in ``df`` (one small action; MERGE semantics)."""
    bad = duplicate_keys(df, keys).limit(5).collect()
    if bad:
        raise ValueError(f"{what}: duplicate keys {list(keys)}: {[tuple(r) for r in bad]}")


def verify_deleted(table: DataFrame, business_date, date_col: str = "business_date") -> None:
    """After replacing a date, no stale rows of that date may remain."""
    if not table.filter(F.col(date_col) == F.lit(business_date)).isEmpty():
        raise RuntimeError(f"rows for {business_date} still present after delete")
