"""Exception report KPIs and scorecard.

Every KPI is an aggregate plan keyed by ``business_date`` (so one call can
serve many days); nothing is computed on the driver.  Rates are decimal
``round(n*100/d, 2)`` with a zero guard.  Aggregates are combined by
equi-joins on the date, never by cross joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import specs
from ..functions.expressions import (date_value, ladder_below, percent, rag_lower_is_better,
                                     timestamp_value)
from ..functions.intervals import Ladders

D = "business_date"


def _threshold(name: str, thresholds: Sequence[specs.ThresholdSpec]) -> specs.ThresholdSpec:
    for t in thresholds:
        if t.metric == name:
            return t
    raise KeyError(name)


def _join_on_date(left: DataFrame, right: DataFrame) -> DataFrame:
    """Full outer join of two per-date aggregates on the date."""
    r = right.withColumnRenamed(D, "_r_date")
    return (left.join(r, left[D] == r["_r_date"], "full_outer")
                .withColumn(D, F.coalesce(F.col(D), F.col("_r_date"))).drop("_r_date"))


# --- K1-K3 -----------------------------------------------------------------

def exception_totals(exceptions: DataFrame) -> DataFrame:
    sev = F.col("severity_code")
    return exceptions.groupBy(D).agg(
        F.count(F.lit(1)).alias("total_exceptions"),
        F.count_if(sev == "CRITICAL").alias("critical_exceptions"),
        F.count_if(sev == "HIGH").alias("high_exceptions"),
        F.count_if(sev == "MEDIUM").alias("medium_exceptions"),
        F.count_if(sev == "LOW").alias("low_exceptions"),
    )


def account_totals(portfolio: DataFrame) -> DataFrame:
    return portfolio.groupBy(D).agg(F.count(F.lit(1)).alias("total_accounts"),
                                    F.countDistinct("customer_id").alias("total_customers"))


_COUNTS = ("total_accounts", "total_customers", "total_exceptions", "critical_exceptions", "high_exceptions",
           "medium_exceptions", "low_exceptions")


def _executive(accounts: DataFrame, totals: DataFrame) -> DataFrame:
    j = _join_on_date(accounts, totals)
    rest = [c for c in totals.columns if c not in (D, *_COUNTS)]
    j = j.select(D, *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in _COUNTS], *rest)
    return j.withColumn("exception_rate", percent("total_exceptions", "total_accounts"))


def executive_totals(portfolio: DataFrame, exceptions: DataFrame) -> DataFrame:
    """K1: accounts, customers, exceptions by severity and the exception rate.

    Rate = exceptions / accounts (not "accounts with an exception")."""
    return _executive(account_totals(portfolio), exception_totals(exceptions))


def report_totals(portfolio: DataFrame, exceptions: DataFrame, as_of) -> DataFrame:
    """K1 and the average SLA failure rate from one aggregate of the exceptions
    per (date, severity), rolled up to the date."""
    n = F.col("total_exceptions")

    def of(severity: str) -> Column:
        return F.sum(F.when(F.col("severity_code") == severity, n).otherwise(0)).alias(f"{severity.lower()}_exceptions")

    totals = sla_performance(exceptions, as_of).groupBy(D).agg(
        F.sum(n).alias("total_exceptions"), *map(of, ("CRITICAL", "HIGH", "MEDIUM", "LOW")),
        F.avg("sla_failure_rate").alias("avg_sla_failure_rate"))
    return _executive(account_totals(portfolio), totals)


def health_status(totals: DataFrame, ladders: Ladders | None = None) -> DataFrame:
    """K2-K3: portfolio health from the rate; executive status from counts.

    No accounts (NULL rate) is ``NO DATA`` (D17)."""
    label = ladder_below("exception_rate", specs.HEALTH_LADDER, specs.HEALTH_OTHERWISE) \
        if ladders is None or ladders.health is None else ladders.health.at("exception_rate", D)
    health = F.when(F.col("exception_rate").isNull(), F.lit("NO DATA")).otherwise(label)
    status = None
    for sev, limit, label in specs.EXECUTIVE_STATUS:
        cond = F.col(f"{sev.lower()}_exceptions") > limit
        status = F.when(cond, F.lit(label)) if status is None else status.when(cond, F.lit(label))
    status = status.otherwise(F.lit(specs.EXECUTIVE_OTHERWISE))
    return totals.withColumns({"portfolio_health": health, "executive_status": status})


# --- K4 source quality -------------------------------------------------------

def source_quality(portfolio: DataFrame, exceptions: DataFrame) -> DataFrame:
    """K4: accounts per source counted before joining (D16), exceptions per
    source, rate per source."""
    a = portfolio.groupBy(D, "source_system_code").agg(F.count(F.lit(1)).alias("total_accounts"))
    sev = F.col("severity_code")
    e = exceptions.groupBy(D, "source_system_code").agg(
        F.count(F.lit(1)).alias("total_exceptions"),
        F.count_if(sev == "CRITICAL").alias("critical_exceptions"),
        F.count_if(sev == "HIGH").alias("high_exceptions"))
    j = a.join(e, [D, "source_system_code"], "left")
    return j.select(
        D, "source_system_code", "total_accounts",
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in
          ("total_exceptions", "critical_exceptions", "high_exceptions")],
        percent(F.coalesce(F.col("total_exceptions"), F.lit(0)), F.col("total_accounts")).alias("exception_rate"),
    )


def source_quality_fanout(portfolio: DataFrame, exceptions: DataFrame) -> DataFrame:
    """K4, parity form: accounts counted *after* joining exceptions on
    (date, account), as the stored procedure does (D16).

    The exceptions are counted per account before the join, so an account row
    meets one row: it stands for as many joined rows as its account has
    exceptions, one if it has none.  Account rows are not sorted (hash join)."""
    p = portfolio.select(D, "source_system_code", "source_account_number").alias("p")
    e = exceptions.groupBy(D, "source_account_number").agg(
        F.count(F.lit(1)).alias("n"), F.count("exception_hash").alias("hashes"),
        F.count_if(F.col("severity_code") == "CRITICAL").alias("critical")).alias("e").hint("shuffle_hash")
    j = p.join(e, (F.col(f"p.{D}") == F.col(f"e.{D}"))
               & (F.col("p.source_account_number") == F.col("e.source_account_number")), "left")
    zero = F.lit(0).cast("long")
    g = j.groupBy(F.col(f"p.{D}").alias(D), F.col("p.source_system_code").alias("source_system_code")).agg(
        F.sum(F.coalesce(F.col("e.n"), F.lit(1).cast("long"))).alias("total_accounts"),
        F.sum(F.coalesce(F.col("e.hashes"), zero)).alias("total_exceptions"),
        F.sum(F.coalesce(F.col("e.critical"), zero)).alias("critical_exceptions"))
    return g.withColumn("exception_rate", percent("total_exceptions", "total_accounts"))


# --- K5-K6 -----------------------------------------------------------------

def area_kpis(exceptions: DataFrame) -> DataFrame:
    """K5: per business area."""
    return exceptions.groupBy(D, "business_area").agg(
        F.count(F.lit(1)).alias("total_exceptions"),
        F.count_if(F.col("severity_code") == "CRITICAL").alias("critical_exceptions"),
        F.count_if(F.col("escalation_required")).alias("escalated_exceptions"))


def owner_queue(exceptions: DataFrame) -> DataFrame:
    """K6: owner work queue."""
    return exceptions.groupBy(D, "business_owner").agg(
        F.count(F.lit(1)).alias("assigned_exceptions"),
        F.count_if(F.col("severity_code") == "CRITICAL").alias("critical_exceptions"),
        F.min("resolution_due_date").alias("earliest_due_date"),
        F.max("resolution_due_date").alias("latest_due_date"))


# --- K7 branch quality -----------------------------------------------------

def branch_quality(portfolio: DataFrame, exceptions: DataFrame) -> DataFrame:
    """K7: accounts per branch (NULL branch kept as its own group, D23) and the
    exceptions of those accounts.  Exceptions that carry their account's
    ``branch_code`` are only grouped; others are matched on (date, source,
    account) first."""
    acct = portfolio.groupBy(D, "branch_code").agg(F.count(F.lit(1)).alias("total_accounts"))
    own = exceptions
    if "branch_code" not in own.columns:
        keys = portfolio.select(D, "source_system_code", "source_account_number", "branch_code").distinct()
        own = exceptions.select(D, "source_system_code", "source_account_number").join(
            keys, [D, "source_system_code", "source_account_number"], "inner")
    ex = own.groupBy(D, "branch_code").agg(F.count(F.lit(1)).alias("exceptions"))
    a, e = acct.alias("a"), ex.alias("e")
    j = a.join(e, (F.col(f"a.{D}") == F.col(f"e.{D}"))
               & F.col("a.branch_code").eqNullSafe(F.col("e.branch_code")), "left")
    n = F.coalesce(F.col("e.exceptions"), F.lit(0))
    return j.select(F.col(f"a.{D}").alias(D), F.col("a.branch_code").alias("branch_code"),
                    F.col("a.total_accounts").alias("total_accounts"), n.alias("exceptions"),
                    percent(n, F.col("a.total_accounts")).alias("branch_exception_rate"))


# --- K8-K9 -----------------------------------------------------------------

def sla_performance(exceptions: DataFrame, as_of) -> DataFrame:
    """K8: per severity, exceptions already past due at ``as_of``."""
    now = timestamp_value(as_of)
    g = exceptions.groupBy(D, "severity_code").agg(
        F.count(F.lit(1)).alias("total_exceptions"),
        F.count_if(F.col("resolution_due_date") < now).alias("overdue_exceptions"),
        F.count_if(F.col("escalation_required")).alias("escalated_exceptions"))
    return g.withColumn("sla_failure_rate", percent("overdue_exceptions", "total_exceptions"))


def trend(exceptions: DataFrame, business_date, days: int = 30) -> DataFrame:
    """K9: per day over ``[d - days, d]`` (both ends included, D18)."""
    d = date_value(business_date)
    return (exceptions.filter(F.col(D).between(F.date_sub(d, days), d))
                      .groupBy(D).agg(
                          F.count(F.lit(1)).alias("total_exceptions"),
                          F.count_if(F.col("severity_code") == "CRITICAL").alias("critical_exceptions"),
                          F.countDistinct("business_owner").alias("active_business_owners")))


# --- K10-K11 scorecard -------------------------------------------------------

def scorecard(portfolio: DataFrame, exceptions: DataFrame, as_of,
              thresholds: Sequence[specs.ThresholdSpec] = specs.THRESHOLDS,
              ladders: Ladders | None = None) -> DataFrame:
    """Four (business_date, kpi_name, kpi_value, kpi_status) rows per day.

    One plan: totals and SLA rolled up from one aggregate and expanded by
    ``inline(array(struct ...))``; thresholds come from the threshold rows.
    No exceptions -> SLA 100 GREEN (D17); SLA status on the unrounded
    failure rate (D20)."""
    j = health_status(report_totals(portfolio, exceptions, as_of), ladders)
    fail = F.coalesce(F.col("avg_sla_failure_rate"), F.lit(0))
    compliance = F.round(F.lit(100) - fail, 2).cast("decimal(10,2)")

    def rag(value: str | Column, metric: str) -> Column:
        if ladders is not None and metric in ladders.thresholds:
            return ladders.thresholds[metric].at(value, D, null_label="RED")
        return rag_lower_is_better(value, _threshold(metric, thresholds))

    health_rag = (F.when(F.col("portfolio_health").isin("EXCELLENT", "GOOD"), F.lit("GREEN"))
                  .when(F.col("portfolio_health") == "FAIR", F.lit("AMBER"))
                  .when(F.col("portfolio_health") == "NO DATA", F.lit("NO DATA"))
                  .otherwise(F.lit("RED")))
    rate_rag = F.when(F.col("exception_rate").isNull(), F.lit("NO DATA")).otherwise(
        rag("exception_rate", "Exception Rate"))

    def row(name: str, value: Column, status: Column) -> Column:
        return F.struct(F.lit(name).alias("kpi_name"), value.cast("string").alias("kpi_value"),
                        status.alias("kpi_status"))

    rows = F.array(
        row("Portfolio Health", F.col("portfolio_health"), health_rag),
        row("Critical Exceptions", F.col("critical_exceptions"),
            rag("critical_exceptions", "Critical Exceptions")),
        row("Exception Rate", F.col("exception_rate"), rate_rag),
        row("SLA Compliance", compliance, rag(fail, "SLA Failure Rate")),
    )
    return j.select(D, F.inline(rows))


def executive_dashboard(portfolio: DataFrame, exceptions: DataFrame, as_of,
                        ladders: Ladders | None = None) -> DataFrame:
    """The dashboard metric row per day."""
    return health_status(report_totals(portfolio, exceptions, as_of), ladders).withColumn(
        "sla_compliance",
        F.round(F.lit(100) - F.coalesce(F.col("avg_sla_failure_rate"), F.lit(0)), 2).cast("decimal(10,2)")
    ).drop("avg_sla_failure_rate")



def priority_sample(exceptions: DataFrame, n: int) -> DataFrame:
    """The ``n`` most urgent exceptions, deterministically ordered
    (priority, due date, content hash) — a top-N report, so the limit is the
    feature.  Spark plans it as TakeOrderedAndProject: each task keeps its
    own top n, only those reach the final merge."""
    return exceptions.orderBy(F.col("priority_level").asc_nulls_first(),
                              F.col("resolution_due_date").asc_nulls_first(),
                              F.col("exception_hash").asc_nulls_first()).limit(n)
