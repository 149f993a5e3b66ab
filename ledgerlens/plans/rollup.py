"""Daily aggregates kept as tables.

``ExceptionRollup`` holds a row per business date: exceptions, critical
exceptions and the set of business owners (as many as the owner table has).
A load that touches some dates writes those dates again and no others; a trend
opens the dates it shows, however long the history of exceptions is.

``AffectedRollup`` holds exact distinct counts that can be merged: bitmaps of
key numbers per date, severity and business area.  Customers and accounts over
any dates, or over all areas, come from the bitmaps alone.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import distinct
from ..sources.tables import DatedTable


class ExceptionRollup:
    def __init__(self, spark: SparkSession, base: str):
        self.table = DatedTable(spark, base)

    def update(self, exceptions: DataFrame, dates: Iterable[dt.date]) -> None:
        """The rollup of ``dates`` from ``exceptions``, which hold all rows of these dates."""
        wanted = list(dates)
        rows = exceptions.where(F.col("business_date").isin(wanted)).groupBy("business_date").agg(
            F.count(F.lit(1)).alias("total_exceptions"),
            F.count_if(F.col("severity_code") == "CRITICAL").alias("critical_exceptions"),
            F.sort_array(F.collect_set("business_owner")).alias("owners"))
        # a row a date: a file a date
        self.table.replace(rows.repartition(1, "business_date"), wanted)

    def trend(self, business_date: dt.date, days: int = 30) -> DataFrame:
        """K9: per day over ``[d - days, d]``, both ends included."""
        rows = self.table.read([business_date - dt.timedelta(days=k) for k in range(days + 1)])
        if rows is None:
            raise ValueError(f"{self.table.base}: not loaded yet")
        return rows.select("business_date", "total_exceptions", "critical_exceptions",
                           F.size("owners").cast("long").alias("active_business_owners"))


#: What is counted exactly once, and the columns that make it up.
AFFECTED = {"customers_affected": ("customer_id",),
            "accounts_affected": ("source_system_code", "source_account_number")}


class AffectedRollup:
    """A3 / Q12 / K1: rows, customers and accounts per date, severity and area."""

    GROUPS = ("business_date", "severity_code", "business_area")

    def __init__(self, spark: SparkSession, base: str, buckets: int = 16):
        self.table = DatedTable(spark, f"{base.rstrip('/')}/states")
        self.numbers = {what: distinct.KeyNumbers(spark, f"{base.rstrip('/')}/{what}", keys, buckets)
                        for what, keys in AFFECTED.items()}

    def update(self, exceptions: DataFrame, dates: Iterable[dt.date]) -> None:
        """The states of ``dates`` from ``exceptions``, which hold all rows of these dates
        and are read three times (so pass stored rows)."""
        wanted = list(dates)
        rows = exceptions.where(F.col("business_date").isin(wanted))
        parts = rows.groupBy(*self.GROUPS).agg(F.count(F.lit(1)).alias("exception_count"))
        for what, numbers in self.numbers.items():
            numbers.extend(rows)
            states = distinct.states(rows, self.GROUPS, numbers).withColumn("counted", F.lit(what))
            parts = parts.unionByName(states, allowMissingColumns=True)
        self.table.replace(parts, wanted)

    def counts(self, dates: Iterable[dt.date] | None = None, by: tuple[str, ...] = GROUPS) -> DataFrame:
        """Exact counts of ``dates`` (all if None) by any of ``GROUPS``, also by none."""
        rows = self.table.read(dates)
        if rows is None:
            raise ValueError(f"{self.table.base}: not loaded yet")
        merged = rows.groupBy(*by, "counted", *distinct.PLACE).agg(
            F.sum("exception_count").alias("exception_count"), distinct.merged_bits())
        return merged.groupBy(*by).agg(
            F.coalesce(F.sum("exception_count"), F.lit(0)).alias("exception_count"),
            *(F.coalesce(F.sum(F.when(F.col("counted") == what, distinct.held())), F.lit(0)).alias(what)
              for what in self.numbers))
