"""Column expressions used across the operators.

All are built-in Spark expressions, so they stay inside whole-stage codegen;
none needs a Python UDF.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..specs import BandSpec, ThresholdSpec


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- F1-F3: cleansing -----------------------------------------------------

def blank_to_null(c: str | Column) -> Column:
    """Trim spaces; an empty result becomes NULL (F1)."""
    t = F.trim(col_(c))
    return F.when(t != F.lit(""), t)


def clean_code(c: str | Column) -> Column:
    """Trim, blank -> NULL, upper-case (F1 + F2)."""
    return F.upper(blank_to_null(c))



# --- keys by hash -----------------------------------------------------------

def by_hash(keys: Sequence[str]) -> list[Column]:
    """``keys`` behind a 64-bit hash of them, to partition a window by.  Rows
    are grouped as by the keys alone, but a sort tells two rows apart by the
    hash: the keys of one day share their date and the first letters of their
    ids, so a sort by them compares whole strings nearly every time."""
    return [F.xxhash64(*keys), *(F.col(k) for k in keys)]


# --- F14: content hash ----------------------------------------------------

def content_text(*parts: str | Column) -> Column:
    """The concatenated parts; NULL parts count as empty strings."""
    return F.concat(*[F.coalesce(col_(p).cast("string"), F.lit("")) for p in parts])


def content_hash(*parts: str | Column) -> Column:
    """Upper-case hex SHA-256 of the UTF-16-LE bytes of the concatenated parts.

    NULL parts count as empty strings; this matches a SQL Server
    ``HASHBYTES('SHA2_256', NVARCHAR)`` key without any Python UDF.
    """
    return F.upper(F.sha2(F.encode(content_text(*parts), "UTF-16LE"), 256))


# --- F8 / F11: time -------------------------------------------------------

def timestamp_value(t) -> Column:
    """``as_of`` argument as a TIMESTAMP_NTZ column (F11: never "now").

    Strings and datetimes are parsed as wall-clock time, independent of the
    session time zone; a Column is passed through."""
    if isinstance(t, Column):
        return t
    if isinstance(t, dt.datetime):
        t = t.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp_ntz(F.lit(str(t)))


def date_value(d) -> Column:
    if isinstance(d, Column):
        return d
    return F.lit(d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d)))


def add_hours(ts: str | Column, hours: str | Column) -> Column:
    return F.timestamp_add("HOUR", col_(hours), col_(ts))


# --- A10: rates -----------------------------------------------------------

def percent(numerator: str | Column, denominator: str | Column, scale: int = 2) -> Column:
    """``round(n * 100 / d, 2)`` as ``decimal(10,2)``; NULL when ``d`` is 0 or NULL.

    Computed in decimal arithmetic (no double), half-up rounding.
    """
    n = col_(numerator).cast("decimal(20,0)")
    d = F.nullif(col_(denominator).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.round(n * F.lit(100) / d, scale).cast(f"decimal(10,{scale})")


# --- F7 / J19: ladders built from configuration rows ----------------------

def band_expr(value: str | Column, bands: Sequence[BandSpec]) -> Column:
    """Value band from band rows: highest band whose minimum is reached.

    The lowest band is the fallback for everything below the next band,
    including NULL and negative values (as the reference code does).
    """
    ordered = sorted(bands, key=lambda b: b.minimum, reverse=True)
    v = col_(value)
    expr = None
    for b in ordered[:-1]:
        cond = v >= F.lit(b.minimum)
        expr = F.when(cond, F.lit(b.name)) if expr is None else expr.when(cond, F.lit(b.name))
    fallback = F.lit(ordered[-1].name)
    return fallback if expr is None else expr.otherwise(fallback)


def lookup_expr(key: str | Column, pairs: Iterable[tuple[object, object]], otherwise) -> Column:
    """CASE key WHEN a THEN b ... ELSE otherwise (small fixed maps)."""
    k = col_(key)
    expr = None
    for a, b in pairs:
        expr = F.when(k == F.lit(a), F.lit(b)) if expr is None else expr.when(k == F.lit(a), F.lit(b))
    return F.lit(otherwise) if expr is None else expr.otherwise(F.lit(otherwise))


def ladder_below(value: str | Column, ladder: Sequence[tuple[Decimal, str]], otherwise: str) -> Column:
    """First label whose (exclusive) upper bound is above ``value``."""
    v = col_(value)
    expr = None
    for bound, label in ladder:
        cond = v < F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def rag_lower_is_better(value: str | Column, t: ThresholdSpec) -> Column:
    """GREEN below the green threshold, AMBER below amber, else RED."""
    v = col_(value)
    return (F.when(v < F.lit(t.green), F.lit("GREEN"))
            .when(v < F.lit(t.amber), F.lit("AMBER"))
            .otherwise(F.lit("RED")))


# --- P9: change predicate -------------------------------------------------

def changed(target: str, source: str, columns: Mapping[str, object], null_safe: bool = False) -> Column:
    """OR over columns of ``COALESCE(t.c, d) <> COALESCE(s.c, d)``.

    With ``null_safe=True`` the test is ``NOT (t.c <=> s.c)`` instead, which
    also sees NULL -> default as a change.
    """
    expr = F.lit(False)
    for c, default in columns.items():
        t, s = F.col(f"{target}.{c}"), F.col(f"{source}.{c}")
        if null_safe:
            diff = ~t.eqNullSafe(s)
        else:
            diff = F.coalesce(t, F.lit(default)) != F.coalesce(s, F.lit(default))
        expr = expr | diff
    return expr


# --- F17: tolerant text/number comparison --------------------------------

def loose_equal(a: str | Column, b: str | Column, tolerance: Decimal = Decimal("0.1")) -> Column:
    """Numeric-if-possible equality with a tolerance, else case-blind text."""
    na = F.regexp_replace(F.trim(col_(a)), "%", "").try_cast("decimal(38,10)")
    nb = F.regexp_replace(F.trim(col_(b)), "%", "").try_cast("decimal(38,10)")
    numeric = na.isNotNull() & nb.isNotNull()
    return (F.when(numeric, F.abs(na - nb) < F.lit(tolerance))
            .otherwise(F.coalesce(F.upper(F.trim(col_(a))), F.lit(""))
                       == F.coalesce(F.upper(F.trim(col_(b))), F.lit(""))))



# --- one-pass rule evaluation -------------------------------------------------

def fire(df, keep: Sequence[str], hits: Sequence[tuple[Column, Column]], alias: str = "h"):
    """One row per (input row, condition that holds), in a single pass.

    ``hits`` are ``(condition, struct)`` pairs.  Rows that fire nothing are
    dropped first by the OR of all conditions (cheap, codegen'd), the rest
    are exploded over ``array(when(c1, s1), ...)`` and the non-firing NULL
    slots filtered out.  ``when`` without ``otherwise`` is NULL for a false
    or NULL condition, so NULL never fires (SQL WHERE semantics).  Plain
    explode + IS NOT NULL keeps the work in whole-stage codegen, where a
    lambda ``filter`` on the array would be interpreted."""
    any_hit = None
    for cond, _ in hits:
        c = F.coalesce(cond, F.lit(False))
        any_hit = c if any_hit is None else any_hit | c
    arr = F.array(*[F.when(cond, struct) for cond, struct in hits])
    return (df.filter(any_hit)
              .select(*keep, F.explode(arr).alias(alias))
              .filter(F.col(alias).isNotNull()))
