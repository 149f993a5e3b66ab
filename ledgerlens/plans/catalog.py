"""Registered queries over the driver's test tables, one per operator.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole tables.  Names and column names match ``oracle_sql.ORACLE``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import intervals
from ..operators import classify, digests, kpi, master, portfolio, reconcile, rules, runlog, upsert
from ..session import ensure_checkpoint_dir
from ..sources import sinks, tables, testdata
from .bank_day import BankDay
from .rollup import AffectedRollup, ExceptionRollup
from .daily import (ISSUE_CHANGE, ISSUE_KEYS, ISSUE_UPDATES, PORTFOLIO_CHANGE, PORTFOLIO_KEYS, read_table,
                    run_daily)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def day(spark: SparkSession, sf_dir: str, **kw) -> BankDay:
    """The priced accounts, which most queries read more than once, are stored
    when a query first needs them; nothing else runs while a query is built.
    Queries that read them once pass ``share=False``."""
    return BankDay.from_testdata(spark, sf_dir, **{"share": True} | kw)


def exceptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day's exceptions, for queries that read nothing else: one pass over
    the accounts, so that these are not stored first."""
    return day(spark, sf_dir, share=False).exceptions


def trend_day(spark: SparkSession, sf_dir: str) -> BankDay:
    """Wallet activity over 45 days up to the trend date (multi-date run)."""
    return day(spark, sf_dir, business_date=testdata.TREND_DATE,
               date_range=(testdata.TREND_DATE - dt.timedelta(days=45), testdata.TREND_DATE))


# --- sources / extraction ---------------------------------------------------

@register("extract_union")
def _(spark, sf):
    return day(spark, sf).staged


@register("extract_incremental")
def _(spark, sf):
    return day(spark, sf, load_type="INCREMENTAL").staged


@register("cleanse")
def _(spark, sf):
    return portfolio.cleanse_accounts(day(spark, sf).staged)


@register("table_counts")
def _(spark, sf):
    d = day(spark, sf)
    frames = {k: v for k, v in d.sources.items()}
    frames["customer_master"] = d.customer_master
    frames["customer_portfolio"] = d.portfolio
    frames["customer_portfolio_exceptions"] = d.exceptions
    return sinks.table_counts(frames)


# --- customer master -----------------------------------------------------------

@register("reject_split")
def _(spark, sf):
    return day(spark, sf).data_quality_issues


@register("master_first_pass")
def _(spark, sf):
    return day(spark, sf).new_master


@register("master_all")
def _(spark, sf):
    return day(spark, sf, master_sources=None).new_master


@register("master_dedupe_counts")
def _(spark, sf):
    return master.dedupe_counts(day(spark, sf).customer_ids)


@register("upsert_master")
def _(spark, sf):
    return day(spark, sf).master_upsert


@register("upsert_metrics")
def _(spark, sf):
    return upsert.action_metrics(day(spark, sf).master_upsert)


@register("delete_stale")
def _(spark, sf):
    d = day(spark, sf)
    return upsert.delete_stale(d.existing_master, d.new_master, ["customer_id"])


@register("customer_master")
def _(spark, sf):
    return day(spark, sf).customer_master


# --- customer exceptions -------------------------------------------------------

@register("issues_dedup")
def _(spark, sf):
    return classify.dedupe_issues(day(spark, sf).data_quality_issues)


@register("issues_classified")
def _(spark, sf):
    return day(spark, sf).customer_exceptions


@register("customer_severity_summary")
def _(spark, sf):
    return classify.severity_summary(day(spark, sf).customer_exceptions)


# --- portfolio -----------------------------------------------------------------

@register("raw_errors")
def _(spark, sf):
    d = day(spark, sf, share=False)
    return portfolio.raw_errors(d.priced, d.as_of)


@register("fx_convert")
def _(spark, sf):
    d = day(spark, sf)
    return portfolio.convert_currency(portfolio.cleanse_accounts(d.staged), d.fx).select(
        "business_date", "source_system_code", "source_account_number", "currency_code", "account_balance",
        "exchange_rate", "base_currency_balance", "rate_found", "rate_missing")


def _enrichment_error(category: str):
    def fn(spark, sf):
        d = day(spark, sf)
        return portfolio.enrichment_errors(d.enriched, d.as_of).filter(F.col("error_category") == category)
    return fn


register("missing_fx")(_enrichment_error("MISSING_EXCHANGE_RATE"))
register("unknown_product")(_enrichment_error("UNKNOWN_PRODUCT"))
register("customer_not_found")(_enrichment_error("CUSTOMER_NOT_FOUND"))


@register("portfolio")
def _(spark, sf):
    return day(spark, sf).portfolio


@register("portfolio_incremental")
def _(spark, sf):
    return day(spark, sf, load_type="INCREMENTAL").portfolio


@register("value_band")
def _(spark, sf):
    return day(spark, sf).portfolio.groupBy("portfolio_value_band").agg(
        F.count(F.lit(1)).alias("account_count"),
        F.sum("base_currency_balance").cast("decimal(28,2)").alias("total_value"))


@register("dated_bands")
def _(spark, sf):
    """Bands and high-value flags of a run over several dates, each row by
    the configuration of its own date."""
    ladders = intervals.Ladders(intervals.bands_of(testdata.dated_bands(spark)),
                                intervals.high_value_of(testdata.dated_high_value(spark)))
    return trend_day(spark, sf).twin(ladders=ladders).portfolio.groupBy(
        "business_date", "portfolio_value_band", "high_value_customer").agg(
        F.count(F.lit(1)).alias("account_count"), F.sum("base_currency_balance").cast("decimal(28,2)").alias("total_value"))


@register("high_value")
def _(spark, sf):
    return day(spark, sf).portfolio.filter(F.col("high_value_customer")).select(
        "source_system_code", "source_account_number", "customer_id", "base_currency_balance",
        "portfolio_value_band")


@register("product_count")
def _(spark, sf):
    return day(spark, sf).portfolio.select("customer_id", "product_count").distinct()


@register("product_count_by_date")
def _(spark, sf):
    """Accounts per customer of a run over several dates."""
    return trend_day(spark, sf).portfolio.select("business_date", "customer_id", "product_count").distinct()


@register("negative_portfolio")
def _(spark, sf):
    d = day(spark, sf)
    return portfolio.negative_portfolio_errors(d.portfolio, d.as_of)


@register("portfolio_errors")
def _(spark, sf):
    return day(spark, sf).portfolio_errors


@register("portfolio_summary")
def _(spark, sf):
    d = day(spark, sf)
    return portfolio.portfolio_summary(d.portfolio, d.portfolio_errors)


@register("value_by_category")
def _(spark, sf):
    return portfolio.value_by_category(day(spark, sf).portfolio)


@register("branch_summary")
def _(spark, sf):
    return portfolio.branch_summary(day(spark, sf).portfolio)


# --- rules ---------------------------------------------------------------------

def _rule(code: str):
    def fn(spark, sf):
        d = day(spark, sf, share=code in ("DQ001", "DQ006"))
        frame = d.enriched if code == "DQ001" else d.priced.withColumn("eligible_for_reporting", F.lit("Y"))
        return rules.attach_rule_config(rules.rule_hits(frame, codes=[code]), d.rules_config, d.owners, d.as_of)
    return fn


for _code in ("DQ001", "DQ002", "DQ003", "DQ004", "DQ005", "DQ006"):
    register(_code.lower())(_rule(_code))


@register("exceptions_union")
def _(spark, sf):
    d = day(spark, sf)
    return rules.attach_rule_config(rules.rule_hits(d.portfolio_rows), d.rules_config, d.owners, d.as_of)


@register("exceptions_dedup")
def _(spark, sf):
    d = day(spark, sf)
    return rules.dedupe_exceptions(
        rules.attach_rule_config(rules.rule_hits(d.portfolio_rows), d.rules_config, d.owners, d.as_of))


@register("exception_counts")
def _(spark, sf):
    d = day(spark, sf)
    return rules.exception_counts(
        rules.attach_rule_config(rules.rule_hits(d.portfolio_rows), d.rules_config, d.owners, d.as_of))


@register("exceptions")
def _(spark, sf):
    return exceptions(spark, sf)


@register("exceptions_staged_rows")
def _(spark, sf):
    return day(spark, sf).staged_exceptions


@register("severity_summary")
def _(spark, sf):
    return classify.severity_summary(exceptions(spark, sf))


@register("area_summary")
def _(spark, sf):
    return rules.area_summary(exceptions(spark, sf))


@register("severity_area_dashboard")
def _(spark, sf):
    return rules.severity_area_dashboard(exceptions(spark, sf))


@register("affected_from_states")
def _(spark, sf):
    """A3 / Q12: customers and accounts per severity and area over the whole
    history, merged from bitmaps per date.  One date is first loaded without its
    critical exceptions and then replaced."""
    d = day(spark, sf, date_range=(dt.date(1900, 1, 1), dt.date(2100, 12, 31)))
    rows = tables.stored(d.exceptions.select(*AffectedRollup.GROUPS, "customer_id", "source_system_code",
                                             "source_account_number"), "affected-exceptions")
    dates = [r[0] for r in rows.select("business_date").distinct().collect()]  # a row a date
    rollup = AffectedRollup(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/affected-{uuid.uuid4().hex}")
    late = F.col("business_date") == F.lit(testdata.BUSINESS_DATE)
    rollup.update(rows.where(~late | (F.col("severity_code") != "CRITICAL")), dates)
    rollup.update(rows, [testdata.BUSINESS_DATE])
    return rollup.counts(by=("severity_code", "business_area"))


@register("owner_next_due")
def _(spark, sf):
    return rules.owner_next_due(exceptions(spark, sf))


@register("daily_severity")
def _(spark, sf):
    return classify.daily_by_severity(exceptions(spark, sf))


@register("daily_area")
def _(spark, sf):
    return classify.daily_by_area(exceptions(spark, sf))


@register("upsert_exceptions")
def _(spark, sf):
    staged, run = day(spark, sf).keyed_pair
    return upsert.upsert(staged, run, ["business_date", "exception_hash"],
                         EXC_CHANGE, [c for c in rules.EXCEPTION_COLUMNS
                                      if c not in ("business_date", "exception_hash")], beside=rules.CONTENT)


EXC_CHANGE = {"severity_code": "", "exception_description": "", "source_account_number": ""}


@register("issues_enriched")
def _(spark, sf):
    """E1-E3 on issues with customers: configured and unconfigured categories."""
    return day(spark, sf, with_customer_issues=True).customer_exceptions


@register("critical_exclusion")
def _(spark, sf):
    """The portfolio without the customers that have an open critical issue."""
    return day(spark, sf, with_customer_issues=True).portfolio


@register("upsert_issues")
def _(spark, sf):
    """Customer exceptions keyed null-safely on (date, customer, category)
    (D5).  The table holds the day's issues without the reviews and with every
    fifth owner reassigned, so the run inserts, updates and leaves rows alone."""
    run = day(spark, sf, with_customer_issues=True).customer_exceptions
    other = (F.col("exception_category") == "Product Validation") & F.col("customer_id").endswith("5")
    table = run.filter(F.col("exception_category") != "Customer Review").withColumn(
        "business_owner", F.when(other, F.lit("Reassigned")).otherwise(F.col("business_owner")))
    return upsert.upsert(table, run, ISSUE_KEYS, ISSUE_CHANGE, ISSUE_UPDATES, null_safe_keys=True,
                         unique_source=True)


@register("upsert_portfolio")
def _(spark, sf):
    """The portfolio keyed on (date, customer, account).  The table holds
    an earlier run without mortgages and with card balances not yet posted."""
    run = portfolio.one_row_per_account(day(spark, sf).portfolio, PORTFOLIO_KEYS)
    card = F.col("source_system_code") == "CARDS"
    table = run.filter(F.col("source_system_code") != "MORTGAGE").withColumn(
        "account_balance", F.when(card, F.lit(0).cast("decimal(18,2)")).otherwise(F.col("account_balance")))
    return upsert.upsert(table, run, PORTFOLIO_KEYS, PORTFOLIO_CHANGE,
                         [c for c in portfolio.PORTFOLIO_COLUMNS if c not in PORTFOLIO_KEYS],
                         null_safe_keys=True, unique_source=True)


@register("exception_sample")
def _(spark, sf):
    """The first 20 exceptions by priority, due date and hash (a top-N report)."""
    return kpi.priority_sample(exceptions(spark, sf), 20)


@register("replace_date")
def _(spark, sf):
    d = day(spark, sf, date_range=(dt.date(1900, 1, 1), dt.date(2100, 12, 31)))
    hist = d.exceptions
    rerun = hist.filter((F.col("business_date") == F.lit(testdata.TREND_DATE)) & (F.col("rule_code") == "DQ004"))
    return upsert.replace_date(hist, rerun, testdata.TREND_DATE)


# --- report -----------------------------------------------------------------

@register("exec_totals")
def _(spark, sf):
    d = day(spark, sf)
    return kpi.executive_totals(d.portfolio, d.exceptions)


@register("health_status")
def _(spark, sf):
    d = day(spark, sf)
    return kpi.health_status(kpi.executive_totals(d.portfolio, d.exceptions))


@register("source_quality")
def _(spark, sf):
    d = day(spark, sf)
    return kpi.source_quality(d.portfolio, d.exceptions)


@register("source_quality_fanout")
def _(spark, sf):
    d = day(spark, sf)
    return kpi.source_quality_fanout(d.portfolio, d.exceptions)


@register("area_kpis")
def _(spark, sf):
    return kpi.area_kpis(exceptions(spark, sf))


@register("owner_queue")
def _(spark, sf):
    return kpi.owner_queue(exceptions(spark, sf))


@register("branch_quality")
def _(spark, sf):
    d = day(spark, sf)
    return kpi.branch_quality(d.portfolio, d.branch_exceptions)


@register("sla_performance")
def _(spark, sf):
    d = day(spark, sf)
    return kpi.sla_performance(d.exceptions, d.report_as_of)


@register("trend_30d")
def _(spark, sf):
    d = trend_day(spark, sf)
    return kpi.trend(d.exceptions, testdata.TREND_DATE, 30)


@register("trend_from_rollup")
def _(spark, sf):
    """K9: the trend from kept daily aggregates.  The last day is first loaded
    without its critical exceptions and then replaced."""
    d = trend_day(spark, sf)
    rows = tables.stored(d.exceptions.select("business_date", "severity_code", "business_owner"), "trend-exceptions")
    days = [testdata.TREND_DATE - dt.timedelta(days=k) for k in range(46)]
    rollup = ExceptionRollup(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/rollup-{uuid.uuid4().hex}")
    last = F.col("business_date") == F.lit(testdata.TREND_DATE)
    rollup.update(rows.where(~last | (F.col("severity_code") != "CRITICAL")), days)
    rollup.update(rows, days[:1])
    return rollup.trend(testdata.TREND_DATE, 30)


@register("scorecard")
def _(spark, sf):
    return day(spark, sf).scorecard


@register("executive_dashboard")
def _(spark, sf):
    d = day(spark, sf)
    return kpi.executive_dashboard(d.portfolio, d.exceptions, d.report_as_of)


# --- reconciliation: run with the first-pass master (baseline) vs the run with
# a master built from all seven sources (current) ------------------------------

def _pair(spark, sf, store=()):
    """The two runs.  A comparison that reads exceptions several times names the
    columns it reads: these are stored once a side."""
    d = day(spark, sf)
    both = d, d.twin(master_sources=None)
    for run in both if store else ():
        run.__dict__["exceptions"] = tables.stored(run.exceptions.select(*store), "exceptions")
    return both


#: What a scorecard reads of the exceptions.
REPORTED = ("business_date", "severity_code", "resolution_due_date", "escalation_required")
#: What the checks read of them besides.
CHECKED = ("exception_hash", "rule_code", *REPORTED)


@register("recon_counts")
def _(spark, sf):
    b, c = _pair(spark, sf, store=REPORTED)
    return reconcile.compare_counts({"portfolio": (b.portfolio, c.portfolio),
                                     "exceptions": (b.exceptions, c.exceptions),
                                     "report": (b.scorecard, c.scorecard)})


@register("recon_aggregates")
def _(spark, sf):
    b, c = _pair(spark, sf)
    return reconcile.compare_aggregates(b.portfolio, c.portfolio)


@register("recon_by_severity")
def _(spark, sf):
    b, c = _pair(spark, sf)
    return reconcile.compare_group_counts(b.exceptions, c.exceptions, ["severity_code"])


@register("recon_by_rule")
def _(spark, sf):
    b, c = _pair(spark, sf)
    return reconcile.compare_group_counts(b.exceptions, c.exceptions, ["rule_code", "severity_code"])


@register("recon_hash_diff")
def _(spark, sf):
    b, c = _pair(spark, sf)
    return reconcile.compare_hashes(b.keyed_exceptions, c.keyed_exceptions, beside=rules.CONTENT)


@register("recon_digest_diff")
def _(spark, sf):
    """The exceptions that one run holds only, by a tree of digests."""
    b, c = _pair(spark, sf, store=("exception_hash", *reconcile.DETAIL))
    return digests.one_sided(b.exceptions, c.exceptions, ["exception_hash"], ["exception_hash", *reconcile.DETAIL])


@register("recon_hash_summary")
def _(spark, sf):
    b, c = _pair(spark, sf)
    return reconcile.hash_summary(reconcile.compare_hashes(b.keyed_exceptions, c.keyed_exceptions, beside=rules.CONTENT))


@register("recon_kpis")
def _(spark, sf):
    b, c = _pair(spark, sf)
    return reconcile.compare_kpis(b.scorecard, c.scorecard)


@register("recon_kpis_by_date")
def _(spark, sf):
    """C5 over a run of several dates."""
    b = trend_day(spark, sf)
    return reconcile.compare_kpis(b.scorecard, b.twin(master_sources=None).scorecard)


@register("recon_missing_extra")
def _(spark, sf):
    """A baseline without mortgages against a run without critical customers."""
    c = day(spark, sf, with_customer_issues=True)
    b = c.portfolio_without_exclusion.filter(F.col("source_system_code") != "MORTGAGE")
    return reconcile.missing_extra(b, c.portfolio, ["business_date", "source_system_code", "source_account_number"])


@register("recon_checks")
def _(spark, sf):
    b, c = _pair(spark, sf, store=CHECKED)
    return reconcile.checks(b.portfolio, c.portfolio, b.exceptions, c.exceptions, b.scorecard, c.scorecard)


@register("recon_verdict")
def _(spark, sf):
    b, c = _pair(spark, sf, store=CHECKED)
    return reconcile.verdict(reconcile.checks(b.portfolio, c.portfolio, b.exceptions, c.exceptions,
                                              b.scorecard, c.scorecard))


@register("baseline_snapshot_accounts")
def _(spark, sf):
    d = day(spark, sf)
    return reconcile.accounts_of_customers(d.sources, d.source_specs, d.customer_master)


# --- run log -----------------------------------------------------------------

@register("runlog_latest")
def _(spark, sf):
    d = day(spark, sf, execution_id="RUN-2026-01-31")
    return runlog.latest(runlog.stage_events(d))


@register("run_daily")
def _(spark, sf):
    """The whole daily run into new tables; returns the dashboard it loaded."""
    d = BankDay.from_testdata(spark, sf, execution_id="RUN-2026-01-31")
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/daily-{uuid.uuid4().hex}"
    run_daily(d, base)
    return read_table(spark, base, "executive_dashboard").withColumn("execution_id", F.lit(d.execution_id))
