"""The daily run (L2-L4): load every table of one business day under a run log.

Tables are versioned (``sources/tables.py``).  The customer master is kept in
key buckets and merged into as it stands in the table; every other table has a
folder per business date.  A stage reads and writes the run's date alone, so
earlier dates keep their files however long the history is, and a failed or
repeated run leaves no half-written and no doubled rows.

Row counts are gathered while the rows are written (``observe``), not by
reading them again.  A stage that a run of the same execution and date has
finished, and whose tables nobody changed since, is not run again (``resume``);
a stage that a killed driver left RUNNING is closed as FAILED first.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import classify, kpi, portfolio, rules, runlog, upsert
from ..sources.tables import BucketedTable, DatedTable, action_counts, observed
from .bank_day import MASTER_CHANGE_COLUMNS, MASTER_UPDATE_COLUMNS, BankDay

PORTFOLIO_KEYS = ("business_date", "customer_id", "source_account_number")
PORTFOLIO_CHANGE = {"account_balance": 0, "account_status": "", "customer_name": ""}

ISSUE_KEYS = ["business_date", "customer_id", "exception_category"]
ISSUE_CHANGE = {"severity_code": "", "exception_description": "", "business_owner": ""}
ISSUE_UPDATES = [c for c in classify.EXCEPTION_COLUMNS if c not in ISSUE_KEYS + ["assigned_date"]]

#: Buckets of the customer master: some 100 MB of customers each at a hundred million.
MASTER_BUCKETS = 16

#: How the exception history treats the rows of an earlier run of the date.
HISTORY_MODES = ("replace", "accumulate")


def check_lookups(day: BankDay) -> None:
    """One small action a lookup: a key that occurs twice would multiply rows."""
    rates = day.run_rates.select(F.upper("currency_code").alias("currency_code"), "effective_date")
    if rates.isEmpty():
        raise ValueError(f"no exchange rates for {day.business_date}")
    upsert.assert_unique(rates, ["currency_code", "effective_date"], "exchange rates")
    upsert.assert_unique(day.products.filter(F.col("product_status") == "ACTIVE"), ["product_code"], "products")
    upsert.assert_unique(day.owners, ["business_area"], "business owners")
    upsert.assert_unique(day.severities, ["severity_code"], "severities")
    upsert.assert_unique(day.categories, ["exception_category"], "exception categories")
    upsert.assert_unique(day.rules_config, ["rule_code"], "rules")


def master_table(spark: SparkSession, base: str) -> BucketedTable:
    return BucketedTable(spark, f"{base}/customer_master", ["customer_id"], MASTER_BUCKETS)


def dated_table(spark: SparkSession, base: str, name: str) -> DatedTable:
    return DatedTable(spark, f"{base}/{name}")


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame | None:
    """The current rows of a table, None before the first load."""
    table = master_table(spark, base) if name == "customer_master" else dated_table(spark, base, name)
    return table.read()


@dataclass
class Counts:
    """The four counts of a stage and the versions of the tables it left."""
    read: int | None = None
    inserted: int = 0
    updated: int = 0
    rejected: int = 0
    versions: dict[str, int] = field(default_factory=dict)

    def numbers(self) -> tuple[int | None, int, int, int]:
        return self.read, self.inserted, self.updated, self.rejected


class DailyRun:
    """Loads of one day into the tables under ``base``."""

    def __init__(self, day: BankDay, base: str, history: str):
        self.day, self.base, self.history, self.spark = day, base, history, day.spark
        #: rows of this run's date in the tables it has loaded
        self.rows: dict[str, int] = {}
        self.shared = False

    def _dated(self, name: str) -> DatedTable:
        return dated_table(self.spark, self.base, name)

    def replaced(self, name: str, rows: DataFrame, counts: Counts) -> int:
        """The date's rows are ``rows``; S16: the table is asked what it holds then."""
        table, (frame, seen) = self._dated(name), observed(rows, n=F.count(F.lit(1)))
        counts.versions[name] = table.replace(frame, [self.day.business_date]).number
        table.verify(self.day.business_date, seen.get["n"])
        self.rows[name] = seen.get["n"]
        return seen.get["n"]

    def merged(self, name: str, label: Callable[[DataFrame, DataFrame], DataFrame], rows: DataFrame,
               counts: Counts) -> Mapping[str, int]:
        """``rows`` merged into what the table holds for the date."""
        table = self._dated(name)
        before = table.current()
        held = table.read([self.day.business_date], before)
        result, seen = action_counts(label(rows.limit(0) if held is None else held, rows))
        counts.versions[name] = table.replace(upsert.merged(result), [self.day.business_date], before).number
        found = seen.get
        self.rows[name] = sum(found.values()) - found["delete"]
        return found

    def watched(self, name: str, reader: str) -> Observation | None:
        """Counts the rows of the day's frame ``name`` as ``reader``, built from it later, is written."""
        if reader in self.day.__dict__:
            return None
        self.day.__dict__[name], seen = observed(getattr(self.day, name), n=F.count(F.lit(1)))
        return seen

    def share(self) -> None:
        """Stores the frames that several tables are made from, once a run."""
        if not self.shared:
            self.day.shared = ("priced", "enriched", "portfolio_rows", "branch_exceptions")
            self.day.materialize()
        self.shared = True

    # --- stages ---------------------------------------------------------------
    def load_customer_master(self, counts: Counts) -> None:
        day, table = self.day, master_table(self.spark, self.base)
        read = self.watched("customer_ids", "data_quality_issues")
        if table.current() is None:
            result, seen = action_counts(day.master_upsert)
            table.load(upsert.merged(result))
            counts.inserted, counts.updated = seen.get["insert"], seen.get["update"]
        else:
            done = table.upsert(day.new_master, MASTER_CHANGE_COLUMNS, MASTER_UPDATE_COLUMNS, delete_unmatched=True)
            counts.inserted, counts.updated = done["INSERT"], done["UPDATE"]
        counts.versions["customer_master"] = table.current().number
        counts.rejected = self.replaced("data_quality_issues", day.data_quality_issues, counts)
        counts.read = read and read.get["n"]

    def load_customer_exceptions(self, counts: Counts) -> None:
        rows = self.day.customer_exceptions
        done = self.merged("customer_exceptions", lambda t, s: upsert.upsert(
            t, s, ISSUE_KEYS, ISSUE_CHANGE, ISSUE_UPDATES, null_safe_keys=True, unique_source=True), rows, counts)
        counts.read = self.rows.get("data_quality_issues")
        counts.inserted, counts.updated = done["insert"], done["update"]
        held = self._dated("customer_exceptions").read([self.day.business_date])
        self.replaced("customer_exception_summary", classify.severity_summary(held), counts)

    def load_customer_portfolio(self, counts: Counts) -> None:
        day = self.day
        read = self.watched("staged", "priced")
        self.share()
        one = portfolio.one_row_per_account(day.portfolio, PORTFOLIO_KEYS)
        done = self.merged("customer_portfolio", lambda t, s: upsert.upsert(
            t, s, PORTFOLIO_KEYS, PORTFOLIO_CHANGE,
            [c for c in portfolio.PORTFOLIO_COLUMNS if c not in PORTFOLIO_KEYS], null_safe_keys=True,
            unique_source=True), one, counts)
        counts.read = read and read.get["n"]
        counts.inserted, counts.updated = done["insert"], done["update"]
        counts.rejected = self.replaced("portfolio_errors", day.portfolio_errors, counts)

    def load_portfolio_exceptions(self, counts: Counts) -> None:
        self.share()
        rows, name = self.day.exceptions, "portfolio_exceptions"
        if self.history == "accumulate":
            # The date's earlier exceptions stay, those found again are refreshed
            held = self._dated(name).read([self.day.business_date])
            rows = rows if held is None else upsert.accumulate(held, rows, ["business_date", "exception_hash"])
        counts.inserted = self.replaced(name, rows, counts)
        counts.read = self.rows.get("customer_portfolio")
        self.replaced("exception_area_summary", rules.area_summary(self.day.exceptions), counts)

    def load_exception_report(self, counts: Counts) -> None:
        self.share()
        day = self.day
        counts.inserted = self.replaced("exception_report", day.scorecard, counts)
        counts.read = self.rows.get("portfolio_exceptions")
        self.replaced("executive_dashboard", kpi.executive_dashboard(day.portfolio, day.exceptions, day.report_as_of,
                                                                     day.ladders), counts)

    def stages(self) -> list[tuple[str, Callable[[Counts], None]]]:
        return list(zip(runlog.STAGES, (self.load_customer_master, self.load_customer_exceptions,
                                        self.load_customer_portfolio, self.load_portfolio_exceptions,
                                        self.load_exception_report)))

    def use_loaded(self, stage: str) -> None:
        """Later stages build on what the tables hold after ``stage``."""
        if stage == runlog.STAGES[0]:
            self.day.__dict__["customer_master"] = master_table(self.spark, self.base).read()
        elif stage == runlog.STAGES[1]:
            # an open critical exception of any earlier day excludes its customer as well
            self.day.customer_exceptions_table = self._dated("customer_exceptions").read()

    def unchanged(self, versions: Mapping[str, int]) -> bool:
        """Whether the tables stand as a finished stage left them, other dates aside."""
        for name, number in versions.items():
            table = master_table(self.spark, self.base) if name == "customer_master" else self._dated(name)
            now = table.current()
            if now is None or number not in table._numbers():
                return False
            then, part = table._load(number), str(self.day.business_date)
            same = now.parts == then.parts if name == "customer_master" else now.parts.get(part) == then.parts.get(part)
            if not same:
                return False
        return True


def run_daily(day: BankDay, base: str, history: str = "replace", resume: bool = False) -> list[str]:
    """Load master, customer exceptions, portfolio, errors, portfolio
    exceptions and report of ``day`` into the tables under ``base``; returns the stages run.
    A stage that raises leaves a FAILED event with its whole message and its
    table as it was.  With ``resume`` finished stages of this execution are passed over."""
    if history not in HISTORY_MODES:
        raise ValueError(f"history mode {history!r} is not one of {HISTORY_MODES}")
    spark, log = day.spark, f"{base}/run_log"
    check_lookups(day)
    run, ran = DailyRun(day, base, history), []
    finished = runlog.finished_stages(spark, log, day.execution_id, day.business_date)
    for stage, load in run.stages():
        told = finished.get(stage)
        if resume and not ran and told is not None and run.unchanged(told["versions"]):
            run.rows |= told["rows"]
        else:
            with runlog.logged_run(spark, log, day.execution_id, stage, day.business_date, day.load_type) as ctx:
                counts = Counts()
                load(counts)
                ctx["counts"] = counts.numbers()
                ctx["message"] = "completed " + json.dumps({"versions": counts.versions, "rows": run.rows})
            ran.append(stage)
        run.use_loaded(stage)
    return ran
