"""Metadata-driven extraction from many account systems.

Each source system names its columns differently; a ``SourceSpec`` maps them
to the canonical names.  The result is one lazily built
``Union(Project(Filter(Scan)))`` plan: the date and status filters sit
directly above each scan, so Catalyst pushes them into the Parquet reader
(and prunes ``business_date`` partitions where the source is partitioned).
Only the spec list — one row per source system — is ever on the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..specs import SourceSpec

LOAD_TYPES = ("FULL", "INCREMENTAL")

STAGED_COLUMNS = (
    "source_system_code", "source_account_number", "customer_id", "product_code",
    "currency_code", "account_balance", "account_status", "business_date",
)


def check_load_type(load_type: str) -> str:
    """Only FULL and INCREMENTAL loads exist."""
    lt = (load_type or "").upper()
    if lt not in LOAD_TYPES:
        raise ValueError(f"load_type must be one of {LOAD_TYPES}, got {load_type!r}")
    return lt


def active_specs(specs: Iterable[SourceSpec], include: Sequence[str] | None = None) -> list[SourceSpec]:
    """Active specs in load-priority order, optionally restricted to ``include``."""
    chosen = [s for s in specs if s.active and (include is None or s.code in include)]
    if not chosen:
        raise ValueError("no active source systems to load")
    return sorted(chosen, key=lambda s: (s.priority, s.code))


def _check_mapping(df: DataFrame, spec: SourceSpec, fields: Iterable[str]) -> None:
    """Every mapped column must exist in the source table."""
    missing = [f for f in fields if f not in df.columns]
    if missing:
        raise ValueError(f"source {spec.code} ({spec.table}) lacks mapped columns {missing}")


def _date_filter(c: Column, business_date, date_range) -> Column | None:
    if date_range is not None:
        lo, hi = date_range
        return c.between(F.lit(_as_date(lo)), F.lit(_as_date(hi)))
    if business_date is not None:
        return c == F.lit(_as_date(business_date))
    return None


def _as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def extract_accounts(tables: Mapping[str, DataFrame], specs: Iterable[SourceSpec],
                     business_date=None, load_type: str = "FULL",
                     date_range: tuple | None = None,
                     include: Sequence[str] | None = None) -> DataFrame:
    """Staged accounts of every active source for one business date.

    INCREMENTAL loads drop rows whose raw status is 'CLOSED' (S7) — compared
    before any upper-casing, and NULL statuses are dropped too, as ``<>``
    on NULL is not true.
    """
    lt = check_load_type(load_type)
    parts = []
    for spec in active_specs(specs, include):
        df = tables[spec.table]
        _check_mapping(df, spec, (spec.account, spec.customer, spec.product, spec.balance,
                                  spec.currency, spec.status, spec.date))
        cond = _date_filter(F.col(spec.date), business_date, date_range)
        if cond is not None:
            df = df.filter(cond)
        if lt == "INCREMENTAL" and spec.supports_incremental:
            df = df.filter(F.col(spec.status) != F.lit("CLOSED"))
        parts.append(df.select(
            F.lit(spec.code).alias("source_system_code"),
            F.col(spec.account).cast("string").alias("source_account_number"),
            F.col(spec.customer).cast("string").alias("customer_id"),
            F.col(spec.product).cast("string").alias("product_code"),
            F.col(spec.currency).cast("string").alias("currency_code"),
            F.col(spec.balance).cast("decimal(18,2)").alias("account_balance"),
            F.col(spec.status).cast("string").alias("account_status"),
            F.col(spec.date).cast("date").alias("business_date"),
        ))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def extract_customer_ids(tables: Mapping[str, DataFrame], specs: Iterable[SourceSpec],
                         include: Sequence[str] | None = None, load_type: str = "FULL",
                         load_time=None) -> DataFrame:
    """S3: (customer_id, source_system_code, source_priority, load_timestamp) from every
    included source, without a date filter.  INCREMENTAL drops NULL ids at the
    source (S8)."""
    lt = check_load_type(load_type)
    parts = []
    for spec in active_specs(specs, include):
        df = tables[spec.table]
        _check_mapping(df, spec, (spec.customer,))
        if lt == "INCREMENTAL":
            df = df.filter(F.col(spec.customer).isNotNull())
        parts.append(df.select(
            F.col(spec.customer).cast("string").alias("customer_id"),
            F.lit(spec.code).alias("source_system_code"),
            F.lit(spec.priority).alias("source_priority"),
            (F.lit(load_time).cast("timestamp_ntz") if load_time is not None
             else F.lit(None).cast("timestamp_ntz")).alias("load_timestamp"),
        ))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
