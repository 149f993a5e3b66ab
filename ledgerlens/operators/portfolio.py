"""Customer portfolio load.

Plan shape for one business date::

    Union(Project(Filter(Scan)))            filters pushed down; cards join two tables
      -> Project (cleanse)                  whole-stage codegen
      -> BroadcastHashJoin fx, product      config-sized sides, explicit broadcast
      == priced accounts: read twice below, so a run stores them once ==
      -> ShuffledHashJoin master, account counts
                                            one row per customer each, keyed by customer; NULL keys salted
      -> Filter (inclusion) -> anti join    critical customers (AQE may broadcast)

Errors are produced in one pass per stage by ``array(when ...) -> inline``
instead of one scan per error type.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import specs
from ..functions.expressions import band_expr, blank_to_null, by_hash, clean_code, fire, timestamp_value
from ..functions.intervals import Ladders

ERROR_COLUMNS = (
    "business_date", "source_system_code", "source_account_number", "customer_id",
    "error_category", "error_description", "logged_date", "execution_id",
)

PORTFOLIO_COLUMNS = (
    "business_date", "source_system_code", "source_account_number", "customer_id",
    "customer_name", "customer_category", "branch_code", "product_code", "product_description",
    "product_category", "regulatory_category", "currency_code", "exchange_rate",
    "account_balance", "base_currency_balance", "account_status", "eligible_for_reporting",
    "portfolio_value_band", "high_value_customer", "product_count",
)


# --- R2 --------------------------------------------------------------------

def cleanse_accounts(staged: DataFrame) -> DataFrame:
    """Trim + blank->NULL ids and codes, upper-case codes and status."""
    return staged.withColumns({
        "customer_id": blank_to_null("customer_id"),
        "product_code": clean_code("product_code"),
        "currency_code": clean_code("currency_code"),
        "account_status": F.upper(F.col("account_status")),
        "account_balance": F.col("account_balance").cast("decimal(18,2)"),
    })


# --- error capture in one pass ---------------------------------------------

def _error(cond: Column, category: str, description: Column | str,
           customer: Column | None = None) -> tuple[Column, Column]:
    desc = F.lit(description) if isinstance(description, str) else description
    return cond, F.struct(
        F.lit(category).alias("error_category"),
        desc.alias("error_description"),
        (customer if customer is not None else F.col("customer_id")).alias("customer_id"),
    )


def _emit_errors(df: DataFrame, candidates: Sequence[tuple[Column, Column]], as_of,
                 execution_id: str | None) -> DataFrame:
    """Turn ``(condition, struct)`` candidates into error rows in one pass."""
    return (fire(df, ("business_date", "source_system_code", "source_account_number"), candidates, "e")
              .select(
                  F.col("business_date"), F.col("source_system_code"), F.col("source_account_number"),
                  F.col("e.customer_id").alias("customer_id"),
                  F.col("e.error_category").alias("error_category"),
                  F.col("e.error_description").alias("error_description"),
                  timestamp_value(as_of).alias("logged_date"),
                  F.lit(execution_id).cast("string").alias("execution_id"),
              ))


def raw_errors(clean: DataFrame, as_of, execution_id: str | None = None) -> DataFrame:
    """MISSING_CUSTOMER, MISSING_PRODUCT, INVALID_BALANCE, de-duplicated."""
    cands = [
        _error(F.col("customer_id").isNull(), *specs.ERR_MISSING_CUSTOMER,
               customer=F.lit(None).cast("string")),
        _error(F.col("product_code").isNull(), *specs.ERR_MISSING_PRODUCT),
        _error(F.col("account_balance").isNull(), *specs.ERR_INVALID_BALANCE),
    ]
    return _emit_errors(clean, cands, as_of, execution_id).distinct()


# --- R4-R6 enrichment ------------------------------------------------------

def convert_currency(clean: DataFrame, fx: DataFrame, base_currency: str = specs.BASE_CURRENCY) -> DataFrame:
    """Left join the day's rate; ``rate_found`` comes from the join, before
    the 1.0 default, so a genuine 1.0 rate is never reported missing (D4).

    ``fx`` is one row per (currency, day): bounded by configuration, broadcast.
    """
    rates = fx.select(
        F.upper(F.col("currency_code")).alias("_fx_ccy"),
        F.col("effective_date").alias("_fx_date"),
        F.col("exchange_rate").cast("decimal(18,8)").alias("_fx_rate"),
    )
    j = clean.join(F.broadcast(rates),
                   (F.col("currency_code") == F.col("_fx_ccy")) & (F.col("business_date") == F.col("_fx_date")),
                   "left")
    rate = F.coalesce(F.col("_fx_rate"), F.lit(Decimal("1")).cast("decimal(18,8)"))
    return j.withColumns({
        "rate_found": F.col("_fx_rate").isNotNull(),
        "exchange_rate": rate,
        "base_currency_balance": F.round(F.col("account_balance") * rate, 2).cast("decimal(18,2)"),
        "rate_missing": F.col("_fx_rate").isNull() & F.col("currency_code").isNotNull()
                        & (F.col("currency_code") != F.lit(base_currency)),
    }).drop("_fx_ccy", "_fx_date", "_fx_rate")


def enrich_product(df: DataFrame, products: DataFrame, active_only: bool = True) -> DataFrame:
    """Product description and categories; unknown products keep NULLs."""
    p = products
    if active_only:
        p = p.filter(F.col("product_status") == "ACTIVE")
    p = p.select(
        F.col("product_code").alias("_pr_code"), "product_description", "product_category",
        "regulatory_category")
    return (df.join(F.broadcast(p), F.col("product_code") == F.col("_pr_code"), "left")
              .drop("_pr_code"))


def salted_key(key: str, spread: str, buckets: int = 4096) -> Column:
    """Join key that spreads NULL keys over many shuffle partitions.

    A NULL key can never match, but a hash shuffle would still send every
    NULL row to a single task; routing them by another column keeps them
    spread.  The companion join condition ``key IS NOT NULL`` guarantees that
    a salted value never matches."""
    return F.coalesce(F.col(key), F.concat(F.lit("\u0000"), (F.xxhash64(spread) % buckets).cast("string")))


def account_counts(df: DataFrame) -> DataFrame:
    """Accounts per customer and date that pass the row-level inclusion rules
    (R11), as one row per customer with a map date -> count.

    A partial/final aggregate: map tasks combine per customer before the
    shuffle, so a customer holding a large share of accounts costs one row
    per task, not one task holding all of them.  The map has one entry per
    date of the run."""
    daily = df.filter(inclusion_flag()).groupBy("customer_id", "business_date").agg(
        F.count(F.lit(1)).cast("int").alias("_n"))
    return daily.groupBy("customer_id").agg(F.map_from_entries(F.collect_list(
        F.struct("business_date", "_n"))).alias("_daily_counts"))


def enrich_customer(df: DataFrame, master: DataFrame, counts: DataFrame | None = None,
                    repeated: str | None = None) -> DataFrame:
    """Name, category and branch from the master (one row per customer),
    plus ``product_count`` when per-customer ``counts`` are given.

    Both joins have the same key, so the account rows are shuffled once for
    both, and they are hash joins that build on the customers of a partition:
    the account rows, many per customer, are neither sorted nor held.  Counts
    that no later column reads are left out of the plan with their join (one
    row per customer on that side).  ``customer_name`` follows ``concat``
    semantics: NULL when either part is NULL (D6).  ``repeated`` names a column
    to add: whether the master has the row's customer more than once, so that
    the join repeats the row."""
    m = master.select(
        F.col("customer_id").alias("_cm_id"),
        F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("customer_name"),
        F.col("customer_category").alias("customer_category"),
        F.col("branch_code").alias("branch_code"),
        F.lit(True).alias("_cm_found"),
    )
    if repeated is not None:
        # by hash: the join still shuffles the customers itself, and may then split a skewed one
        m = m.withColumn(repeated, F.count(F.lit(1)).over(Window.partitionBy(*by_hash(["_cm_id"]))) > 1)
    key = salted_key("customer_id", "source_account_number")  # no column: it is not shuffled beside the id
    j = df.join(m.hint("shuffle_hash"), (key == F.col("_cm_id")) & F.col("customer_id").isNotNull(), "left")
    if counts is not None:
        # NULL where the customer has no included account on the row's date
        n = counts.withColumnRenamed("customer_id", "_n_id")
        j = j.join(n.hint("shuffle_hash"), (key == F.col("_n_id")) & F.col("customer_id").isNotNull(), "left") \
             .withColumn("product_count", F.try_element_at("_daily_counts", F.col("business_date"))) \
             .drop("_n_id", "_daily_counts")
    if repeated is not None:
        j = j.withColumn(repeated, F.coalesce(F.col(repeated), F.lit(False)))
    return (j.withColumn("in_master", F.coalesce(F.col("_cm_found"), F.lit(False)))
             .drop("_cm_id", "_cm_found"))


def enrichment_errors(enriched: DataFrame, as_of, execution_id: str | None = None) -> DataFrame:
    """MISSING_EXCHANGE_RATE, UNKNOWN_PRODUCT, CUSTOMER_NOT_FOUND in one pass."""
    fx_cat, fx_text = specs.ERR_MISSING_FX
    up_cat, up_text = specs.ERR_UNKNOWN_PRODUCT
    cands = [
        _error(F.col("rate_missing"), fx_cat, F.concat(F.lit(fx_text), F.col("currency_code"))),
        _error(F.col("product_description").isNull(), up_cat,
               F.concat(F.lit(up_text), F.coalesce(F.col("product_code"), F.lit("")))),
        _error(F.col("customer_id").isNotNull() & ~F.col("in_master"), *specs.ERR_CUSTOMER_NOT_FOUND),
    ]
    return _emit_errors(enriched, cands, as_of, execution_id)


def price_accounts(staged: DataFrame, fx: DataFrame, products: DataFrame) -> DataFrame:
    """Cleanse + currency + product enrichment: one row per staged row, no shuffle."""
    return enrich_product(convert_currency(cleanse_accounts(staged), fx), products)


def enrich_priced(priced: DataFrame, master: DataFrame) -> DataFrame:
    """Customer enrichment and account counts; reads ``priced`` twice."""
    return enrich_customer(priced, master, account_counts(priced)) \
        .withColumn("eligible_for_reporting", F.lit("Y"))


def stage_accounts(staged: DataFrame, fx: DataFrame, products: DataFrame, master: DataFrame) -> DataFrame:
    """Cleanse + currency + product + customer enrichment of every staged row."""
    return enrich_priced(price_accounts(staged, fx, products), master)


# --- R7-R11 ----------------------------------------------------------------

def inclusion_flag() -> Column:
    """Exclude CLOSED, zero balance, unknown product, missing rate, NULL customer.

    A NULL balance is *kept*: ``NULL = 0`` is not true.  Written as a
    conjunction, it tells the optimizer that included rows have a product and a
    customer: rules on their absence, and columns read by them alone, leave the plan."""
    closed, zero = F.col("account_status") == "CLOSED", F.col("base_currency_balance") == 0
    return (F.col("product_description").isNotNull() & F.col("customer_id").isNotNull()
            & ~F.coalesce(closed, F.lit(False)) & ~F.coalesce(zero, F.lit(False))
            & ~F.coalesce(F.col("rate_missing"), F.lit(False)))


def critical_customers(customer_exceptions: DataFrame) -> DataFrame:
    """Customers with an OPEN CRITICAL customer-master exception."""
    return (customer_exceptions
            .filter((F.col("exception_status") == "OPEN") & (F.col("severity_code") == "CRITICAL")
                    & F.col("customer_id").isNotNull())
            .select("customer_id").distinct())


def include_accounts(enriched: DataFrame, critical: DataFrame | None = None) -> DataFrame:
    """Inclusion rules then drop customers with open critical exceptions."""
    # no included row lacks its rate: as a constant the flag needs no place in shuffled rows
    kept = enriched.filter(inclusion_flag()).withColumn("rate_missing", F.lit(False))
    if critical is not None:
        kept = kept.join(critical.select("customer_id"), "customer_id", "left_anti")
    return kept


def flag_included(accounts: DataFrame, critical: DataFrame, flag: str) -> DataFrame:
    """Every account, with ``flag``: whether ``include_accounts`` keeps it."""
    c = critical.select(F.col("customer_id").alias("_critical"))
    j = accounts.join(c, (salted_key("customer_id", "source_account_number") == F.col("_critical"))
                      & F.col("customer_id").isNotNull(), "left")
    return j.withColumn(flag, inclusion_flag() & F.col("_critical").isNull()).drop("_critical")


def add_portfolio_metrics(included: DataFrame, bands: Sequence[specs.BandSpec] = specs.VALUE_BANDS,
                          high_value_minimum: Decimal = specs.HIGH_VALUE_MINIMUM,
                          ladders: Ladders | None = None) -> DataFrame:
    """Value band and high-value flag per account; product_count =
    included accounts per customer and date.  ``ladders`` holds dated
    configuration, which goes before the fixed one.

    ``stage_accounts`` already attached product_count through the customer
    join (see ``account_counts``); it counts the rows passing the row-level
    rules, which equals the portfolio count for every customer that survives
    the critical-customer anti join (that join removes whole customers).
    Frames without it get the count by a partial aggregate joined back."""
    dated = ladders or Ladders()
    band = band_expr("base_currency_balance", bands) if dated.bands is None \
        else dated.bands.at("base_currency_balance", "business_date")
    high = F.col("base_currency_balance") >= F.lit(high_value_minimum) if dated.high_value is None \
        else dated.high_value.at("base_currency_balance", "business_date") == "true"
    out = included.withColumns({
        "portfolio_value_band": band,
        "high_value_customer": F.coalesce(high, F.lit(False)),
        "eligible_for_reporting": F.lit("Y"),
    })
    if "product_count" in out.columns:
        return out
    counts = included.groupBy("business_date", "customer_id").agg(
        F.count(F.lit(1)).cast("int").alias("product_count"))
    return out.join(counts, ["business_date", "customer_id"], "left")


def one_row_per_account(portfolio: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the largest balance, ties by the remaining columns in
    order.  Accounts that occur more than once are reported by DQ006; a keyed
    table can hold one of their rows only.  Rows are shuffled by the hash that
    a null-safe ``upsert`` joins by, which then moves none of them again."""
    rest = [c for c in PORTFOLIO_COLUMNS if c not in (*keys, "account_balance")]
    w = Window.partitionBy(*by_hash(keys)).orderBy(F.col("account_balance").desc_nulls_last(),
                                                   *(F.col(c).asc_nulls_last() for c in rest))
    return portfolio.repartition(F.xxhash64(*keys)).withColumn("_rn", F.row_number().over(w)) \
        .filter(F.col("_rn") == 1).drop("_rn")


def to_portfolio(df: DataFrame) -> DataFrame:
    return df.select(*PORTFOLIO_COLUMNS)


def negative_portfolio_errors(portfolio: DataFrame, as_of, execution_id: str | None = None,
                              limit: Decimal = specs.NEGATIVE_PORTFOLIO_LIMIT) -> DataFrame:
    """Balances below the limit are logged but stay in the portfolio."""
    return _emit_errors(portfolio, [_error(F.col("base_currency_balance") < F.lit(limit),
                                           *specs.ERR_NEGATIVE_PORTFOLIO)], as_of, execution_id)


def portfolio_errors(staged: DataFrame, enriched: DataFrame, portfolio: DataFrame, as_of,
                     execution_id: str | None = None) -> DataFrame:
    """All error rows of a portfolio run (R3 + R4-R6 + R12).  ``staged`` may be
    the priced rows: cleansing twice changes nothing."""
    clean = cleanse_accounts(staged)
    return (raw_errors(clean, as_of, execution_id)
            .unionByName(enrichment_errors(enriched, as_of, execution_id))
            .unionByName(negative_portfolio_errors(portfolio, as_of, execution_id)))


# --- R13-R14 summaries ----------------------------------------------------

def portfolio_summary(portfolio: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Customers, accounts and value per business date (+ errors)."""
    s = portfolio.groupBy("business_date").agg(
        F.countDistinct("customer_id").alias("total_customers"),
        F.count(F.lit(1)).alias("total_accounts"),
        F.sum("base_currency_balance").cast("decimal(28,2)").alias("total_portfolio_value"),
    )
    if errors is not None:
        e = errors.groupBy("business_date").agg(
            F.count(F.lit(1)).alias("errors"),
            F.countDistinct("source_system_code", "source_account_number").alias("rows_with_error"))
        s = s.join(e, "business_date", "left").fillna(0, ["errors", "rows_with_error"])
    return s


def value_by_category(portfolio: DataFrame) -> DataFrame:
    """Accounts and value per (date, product category)."""
    return portfolio.groupBy("business_date", "product_category").agg(
        F.count(F.lit(1)).alias("account_count"),
        F.sum("base_currency_balance").cast("decimal(28,2)").alias("total_value"),
    )


def branch_summary(portfolio: DataFrame) -> DataFrame:
    """Customers, accounts and value per branch (NULL branch kept)."""
    return portfolio.groupBy("business_date", "branch_code").agg(
        F.countDistinct("customer_id").alias("customer_count"),
        F.count(F.lit(1)).alias("account_count"),
        F.sum("base_currency_balance").cast("decimal(28,2)").alias("total_value"),
    )

