"""One business day of the pipeline as lazily composed DataFrames (L4).

``BankDay`` wires the operators in the order of the nightly run:

    customer ids -> master (M1) -> upsert into the existing master (U1)
    accounts -> cleanse -> fx/product/customer enrichment -> portfolio (R*)
    portfolio -> rules (Q*) -> KPIs / scorecard (K*)

Each attribute is a DataFrame built on first access; nothing runs until an
action.  ``materialize()`` cuts the lineage of the frames that feed several
outputs (enriched accounts, master, portfolio, exceptions): they are written as
Parquet to the cluster's ``spark.checkpoint.dir``, so a multi-output run reads
the sources once, later reads prune columns, and executors may be lost.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import specs
from ..functions.intervals import Ladders
from ..operators import classify, kpi, master, portfolio, rules, upsert
from ..sources import config_tables, extract, tables, testdata

MASTER_CHANGE_COLUMNS = {"customer_status": "", "customer_category": ""}
MASTER_UPDATE_COLUMNS = ("first_name", "last_name", "customer_category", "branch_code",
                         "customer_status", "last_updated_date", "primary_source_system_code")


class BankDay:
    def __init__(self, spark: SparkSession, sources: Mapping[str, DataFrame], existing_master: DataFrame,
                 business_date: dt.date, as_of: dt.datetime, execution_id: str | None = None,
                 load_type: str = "FULL", source_specs: Sequence[specs.SourceSpec] = specs.SOURCES,
                 master_sources: Sequence[str] | None = specs.FIRST_PASS_SOURCES,
                 customer_exceptions_table: DataFrame | None = None,
                 date_range: tuple | None = None, report_as_of: dt.datetime | None = None,
                 share: bool = False, extra_issues: DataFrame | None = None,
                 bands: Sequence[specs.BandSpec] = specs.VALUE_BANDS,
                 thresholds: Sequence[specs.ThresholdSpec] = specs.THRESHOLDS,
                 ladders: Ladders | None = None):
        self.spark = spark
        self.sources = dict(sources)
        self.existing_master = existing_master
        self.business_date = business_date
        self.as_of = as_of
        self.execution_id = execution_id
        self.load_type = extract.check_load_type(load_type)
        self.source_specs = list(source_specs)
        self.master_sources = master_sources
        self.customer_exceptions_table = customer_exceptions_table
        self.date_range = date_range
        self.report_as_of = report_as_of or as_of
        self.share = share
        self.extra_issues = extra_issues
        self.bands = list(bands)
        self.thresholds = list(thresholds)
        #: dated configuration, which goes before ``bands`` and ``thresholds``
        self.ladders = ladders
        #: frames that ``materialize`` has stored
        self.kept: set[str] = set()

    # --- construction from the driver's test tables --------------------------
    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, **kw) -> BankDay:
        t = testdata.read_tables(spark, sf_dir)
        kw.setdefault("business_date", testdata.BUSINESS_DATE)
        kw.setdefault("as_of", testdata.AS_OF)
        kw.setdefault("report_as_of", testdata.REPORT_AS_OF)
        if kw.pop("with_customer_issues", False):
            kw["extra_issues"] = testdata.customer_issues(t, kw["business_date"], kw["as_of"])
        return cls(spark, testdata.account_systems(t), testdata.seeded_master(t), **kw)

    def twin(self, **changed) -> BankDay:
        """The same day with other settings; accounts priced by this one are shared."""
        kw = {k: getattr(self, k) for k in ("business_date", "as_of", "execution_id", "load_type", "source_specs",
                                            "master_sources", "customer_exceptions_table", "date_range",
                                            "report_as_of", "share", "extra_issues", "bands", "thresholds", "ladders")} | changed
        other = BankDay(self.spark, self.sources, self.existing_master, **kw)
        if not {"load_type", "source_specs", "date_range", "business_date"} & changed.keys():
            other.__dict__["priced"] = self.priced
        return other

    # --- configuration (config-sized) ----------------------------------------
    @cached_property
    def fx(self) -> DataFrame:
        return config_tables.exchange_rates(self.spark)

    @cached_property
    def products(self) -> DataFrame:
        return config_tables.products(self.spark)

    @cached_property
    def rules_config(self) -> DataFrame:
        return config_tables.exception_rules(self.spark)

    @cached_property
    def owners(self) -> DataFrame:
        return config_tables.business_owners(self.spark)

    @cached_property
    def severities(self) -> DataFrame:
        return config_tables.exception_severities(self.spark)

    @cached_property
    def categories(self) -> DataFrame:
        return config_tables.exception_categories(self.spark)

    # --- customer master ---------------------------------------------
    @cached_property
    def customer_ids(self) -> DataFrame:
        return extract.extract_customer_ids(self.sources, self.source_specs, include=self.master_sources,
                                            load_type=self.load_type)

    @cached_property
    def new_master(self) -> DataFrame:
        return master.build_customer_master(self.customer_ids, self.as_of)

    @cached_property
    def master_upsert(self) -> DataFrame:
        return upsert.upsert(self.existing_master, self.new_master, ["customer_id"],
                             MASTER_CHANGE_COLUMNS, MASTER_UPDATE_COLUMNS, delete_unmatched=True)

    @cached_property
    def customer_master(self) -> DataFrame:
        return upsert.merged(self.master_upsert)

    @cached_property
    def data_quality_issues(self) -> DataFrame:
        missing = master.reject_missing_keys(self.customer_ids, self.business_date, self.as_of,
                                             self.execution_id)
        return missing if self.extra_issues is None else missing.unionByName(self.extra_issues)

    # --- customer exceptions -------------------------------------------
    @cached_property
    def customer_exceptions(self) -> DataFrame:
        return classify.customer_exceptions(self.data_quality_issues, self.categories, self.severities,
                                            self.owners, self.business_date, self.as_of)

    # --- portfolio -----------------------------------------------------
    @cached_property
    def staged(self) -> DataFrame:
        return extract.extract_accounts(self.sources, self.source_specs,
                                        business_date=None if self.date_range else self.business_date,
                                        load_type=self.load_type, date_range=self.date_range)

    @cached_property
    def run_rates(self) -> DataFrame:
        """The rates of the run's dates only, so that the broadcast does not grow with the rate history."""
        first, last = self.date_range or (self.business_date, self.business_date)
        return self.fx.filter(F.col("effective_date").between(F.lit(first), F.lit(last)))

    @cached_property
    def priced(self) -> DataFrame:
        """Cleansed accounts with rate and product.  Several frames read them,
        so a sharing run stores them once."""
        df = portfolio.price_accounts(self.staged, self.run_rates, self.products)
        return tables.stored(df, "priced") if self.share else df

    @cached_property
    def enriched(self) -> DataFrame:
        return portfolio.enrich_priced(self.priced, self.customer_master)

    @cached_property
    def critical_customers(self) -> DataFrame:
        src = self.customer_exceptions_table if self.customer_exceptions_table is not None \
            else self.customer_exceptions
        return portfolio.critical_customers(src)

    @cached_property
    def portfolio_rows(self) -> DataFrame:
        """Included accounts with metrics and the enrichment flags still attached."""
        inc = portfolio.include_accounts(self.enriched, self.critical_customers)
        return portfolio.add_portfolio_metrics(inc, self.bands, ladders=self.ladders)

    @cached_property
    def portfolio(self) -> DataFrame:
        return portfolio.to_portfolio(self.portfolio_rows)

    @cached_property
    def portfolio_without_exclusion(self) -> DataFrame:
        """What the portfolio would be if no customer were excluded."""
        return portfolio.to_portfolio(portfolio.add_portfolio_metrics(portfolio.include_accounts(self.enriched)))

    @cached_property
    def portfolio_errors(self) -> DataFrame:
        return portfolio.portfolio_errors(self.priced, self.enriched, self.portfolio, self.as_of,
                                          self.execution_id)

    # --- exceptions ----------------------------------------------------
    @cached_property
    def ruled_rows(self) -> DataFrame:
        """The accounts of the portfolio as the rules read them.  Unless portfolio rows are
        stored, their duplicates are found before the master is joined: twins share the shuffles."""
        if "portfolio_rows" in self.kept:
            return self.portfolio_rows
        return rules.flag_accounts(portfolio.include_accounts(self.priced, self.critical_customers), self.customer_master)

    @cached_property
    def keyed_exceptions(self) -> DataFrame:
        """``exceptions`` for a join by their hash: laid by ``rules.CONTENT``."""
        return rules.run_rules_by_content(self.ruled_rows, self.rules_config, self.owners, self.severities, self.as_of)[0]

    @cached_property
    def keyed_pair(self) -> tuple[DataFrame, DataFrame]:
        """``staged_exceptions`` and ``exceptions`` laid by ``rules.CONTENT``, from one pass over the accounts."""
        accounts = portfolio.flag_included(self.priced, self.critical_customers, "in_portfolio")
        return rules.run_rules_by_content(rules.flag_accounts(accounts, self.customer_master, "in_portfolio"),
                                          self.rules_config, self.owners, self.severities, self.as_of, "in_portfolio")

    @cached_property
    def exceptions(self) -> DataFrame:
        # the in_master flag of the enrichment join is reused: no second master join
        return self.branch_exceptions.drop("branch_code")

    @cached_property
    def branch_exceptions(self) -> DataFrame:
        """The exceptions with the branch of their account."""
        return rules.run_rules(self.ruled_rows, self.rules_config, self.owners, self.severities,
                               self.as_of, carry=("branch_code",))

    @cached_property
    def staged_exceptions(self) -> DataFrame:
        """The rule engine on every enriched row, before the inclusion filter."""
        return rules.run_rules(self.enriched, self.rules_config, self.owners, self.severities, self.as_of)

    # --- report --------------------------------------------------------
    @cached_property
    def scorecard(self) -> DataFrame:
        return kpi.scorecard(self.portfolio, self.exceptions, self.report_as_of, self.thresholds,
                             self.ladders)

    #: Frames in the order in which they build on each other.
    DERIVED = ("customer_master", "priced", "enriched", "critical_customers", "portfolio_rows", "portfolio",
               "portfolio_errors", "ruled_rows", "keyed_exceptions", "keyed_pair", "branch_exceptions", "exceptions",
               "staged_exceptions", "scorecard")
    #: Frames that several outputs read.
    shared = ("customer_master", "priced", "enriched", "portfolio_rows", "branch_exceptions")

    def materialize(self, names: Sequence[str] | None = None) -> BankDay:
        """Store the shared frames and build every later output on top of them."""
        for n in names or self.shared:
            df = tables.stored(getattr(self, n), n)
            # drop the frames built on the old lineage, then pin this one
            for dep in self.DERIVED[self.DERIVED.index(n):]:
                self.__dict__.pop(dep, None)
            self.__dict__[n] = df
            self.kept.add(n)
        return self
