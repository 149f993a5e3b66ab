"""Adapter from the driver's TPC-H-style test tables to the seven account systems.

The account systems are *derived* from the given tables (so the work grows
with them): every customer, order, line item, part, event and supplier row
becomes an account in one of the systems.  Deliberate defects are injected
by simple arithmetic rules on the keys (blank ids, lower-case codes, unknown
products, unrated currencies, NULL balances, closed accounts, duplicate card
numbers, ghost customers) so that every rule and error path fires at any
scale.  The same rules are written in SQL for the DuckDB oracle.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import specs

BUSINESS_DATE = dt.date(2026, 1, 31)
AS_OF = dt.datetime(2026, 1, 31, 18, 0, 0)
# When the report evaluates SLAs: 12 hours after logging.
REPORT_AS_OF = dt.datetime(2026, 2, 1, 6, 0, 0)
SEED_CREATED = dt.datetime(2026, 1, 1, 8, 0, 0)
# Event days are shifted so the last event day lands on BUSINESS_DATE.
MOBILE_DAY_SHIFT = 732
# Wallet days used for the 30-day trend.
TREND_DATE = dt.date(2026, 1, 25)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def ts_literal(t: dt.datetime) -> Column:
    """A TIMESTAMP_NTZ literal that does not depend on any time zone setting."""
    return F.to_timestamp_ntz(F.lit(t.strftime("%Y-%m-%d %H:%M:%S")))


def read_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def _pick(key: Column, values: list[str]) -> Column:
    expr = None
    for i, v in enumerate(values):
        cond = key == F.lit(i)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return expr


def _id(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(prefix), *[p.cast("string") for p in parts])


def _money(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def account_systems(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The seven source tables, each with its own column names."""
    d = F.lit(BUSINESS_DATE)
    c, o, li, p, e, s = (t["customer"], t["orders"], t["lineitem"], t["part"], t["events"],
                         t["supplier"])

    core = c.select(
        _id("CB", F.col("c_custkey")).alias("account_number"),
        F.when(F.col("c_custkey") % 97 == 0, F.lit("   "))
         .otherwise(_id(" CUST", F.col("c_custkey"))).alias("customer_number"),
        F.when(F.col("c_custkey") % 50 == 0, F.lit(None).cast("string"))
         .otherwise(_pick(F.col("c_custkey") % 3, [" sav001 ", "CUR001", "cur001"])).alias("product_code"),
        _money(F.col("c_acctbal")).alias("account_balance"),
        _pick(F.col("c_nationkey") % 6, ["USD", "EUR", "eur", "GBP", "ZAR", "XXX"]).alias("currency"),
        F.when(F.col("c_custkey") % 20 == 0, F.lit("CLOSED"))
         .when(F.col("c_custkey") % 45 == 0, F.lit("closed"))
         .when(F.col("c_custkey") % 7 == 0, F.lit("active"))
         .otherwise(F.lit("ACTIVE")).alias("account_status"),
        d.alias("record_date"),
    )

    loans = o.select(
        _id("LN", F.col("o_orderkey")).alias("loan_number"),
        _id("CUST", F.col("o_custkey")).alias("client_id"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.lit("HOME_LOAN"))
         .otherwise(F.lit("PERSONAL_LOAN")).alias("loan_product"),
        _money(F.col("o_totalprice")).alias("outstanding_amount"),
        _pick(F.col("o_orderkey") % 5, ["USD", "EUR", "GBP", "ZAR", "JPY"]).alias("loan_currency"),
        F.when(F.col("o_orderstatus") == "F", F.lit("CLOSED")).otherwise(F.lit("ACTIVE")).alias("loan_status"),
        d.alias("snapshot_date"),
    )

    cards = li.join(o.select("o_orderkey", "o_custkey"), li["l_orderkey"] == o["o_orderkey"]).select(
        _id("CARD", F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber")).alias("card_account_number"),
        _id("CUST", F.col("o_custkey")).alias("client_number"),
        F.when(F.col("l_returnflag") == "R", F.lit("GOLD_CARD")).otherwise(F.lit("STANDARD_CARD")).alias("card_product"),
        F.when(F.col("l_quantity") >= 50, F.lit(None).cast("decimal(18,2)"))
         .when(F.col("l_returnflag") == "R", -_money(F.col("l_extendedprice")))
         .otherwise(_money(F.col("l_extendedprice"))).alias("credit_balance"),
        _pick(F.col("l_suppkey") % 3, ["USD", "EUR", "GBP"]).alias("card_currency"),
        F.when(F.col("l_linestatus") == "O", F.lit("ACTIVE")).otherwise(F.lit("active")).alias("card_status"),
        d.alias("business_date"),
    )

    investments = p.select(
        _id("INV", F.col("p_partkey")).alias("investment_id"),
        _id("CUST", F.col("p_partkey") * 7).alias("investor_id"),
        F.when(F.col("p_size") % 2 == 0, F.lit("EQUITY_FUND")).otherwise(F.lit("BOND_FUND")).alias("investment_product"),
        _money(_money(F.col("p_retailprice")) * 1000).alias("market_value"),
        F.when(F.col("p_partkey") % 2 == 0, F.lit("USD")).otherwise(F.lit("EUR")).alias("investment_currency"),
        F.lit("ACTIVE").alias("investment_status"),
        d.alias("valuation_date"),
    )

    mortgages = o.filter(F.col("o_totalprice") > 400000).select(
        _id("MORT", F.col("o_orderkey")).alias("mortgage_number"),
        _id("CUST", F.col("o_custkey")).alias("client_code"),
        F.lit("HOME").alias("mortgage_type"),
        _money(F.col("o_totalprice")).alias("balance_amount"),
        F.lit("USD").alias("currency_code"),
        F.when(F.col("o_orderstatus") == "F", F.lit("CLOSED")).otherwise(F.lit("ACTIVE")).alias("status"),
        d.alias("effective_date"),
    )

    wallets = e.select(
        _id("WAL", F.col("event_id")).alias("wallet_id"),
        _id("CUST", F.col("user_id")).alias("customer_number"),
        F.lit("MOBILE_WALLET").alias("wallet_product"),
        F.when(F.col("event_type") == "error", -_money(F.col("value")))
         .otherwise(_money(F.col("value"))).alias("wallet_balance"),
        F.when(F.col("event_type") == "purchase", F.lit("ZAR")).otherwise(F.lit("USD")).alias("wallet_currency"),
        F.lit("ACTIVE").alias("wallet_status"),
        F.date_add(F.to_date(F.col("ts")), MOBILE_DAY_SHIFT).alias("load_date"),
    )

    forex = s.select(
        _id("FX", F.col("s_suppkey")).alias("trade_id"),
        _id("CUST", F.col("s_suppkey") + 1000000).alias("customer_id"),
        F.when(F.col("s_nationkey") % 2 == 0, F.lit("FX_FORWARD")).otherwise(F.lit("FX_SWAP")).alias("forex_product"),
        _money(-_money(F.col("s_acctbal")) * 10).alias("trade_amount"),
        F.lit("GBP").alias("trade_currency"),
        F.lit("ACTIVE").alias("trade_status"),
        d.alias("trade_date"),
    )

    return {
        "core_banking_accounts": core,
        "loan_accounts": loans,
        "card_accounts": cards,
        "investment_accounts": investments,
        "mortgage_accounts": mortgages,
        "mobile_wallet": wallets,
        "forex_accounts": forex,
    }


def seeded_master(t: dict[str, DataFrame]) -> DataFrame:
    """An existing customer master (the upsert target) seeded from the customer
    table, with real names, segments and branches.  Customers known only from
    account feeds are new to it; customers without a usable account id leave it."""
    c = t["customer"]
    return c.select(
        _id("CUST", F.col("c_custkey")).alias("customer_id"),
        F.lower(F.col("c_mktsegment")).alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("PREMIUM"))
         .when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("BUSINESS"))
         .otherwise(F.lit("STANDARD")).alias("customer_category"),
        F.concat(F.lit("BR"), F.lpad((F.col("c_nationkey") % 9 + 1).cast("string"), 3, "0")).alias("branch_code"),
        F.lit("ACTIVE").alias("customer_status"),
        ts_literal(SEED_CREATED).alias("created_date"),
        F.lit(None).cast("timestamp_ntz").alias("last_updated_date"),
        F.lit(None).cast("string").alias("primary_source_system_code"),
    )


def customer_issues(t: dict[str, DataFrame], business_date: dt.date, as_of: dt.datetime) -> DataFrame:
    """Customer-level data-quality issues of the day: overdrawn customers (a
    configured CRITICAL category), customers without a known segment (a
    configured MEDIUM one) and customers to review (not configured)."""
    c = t["customer"]

    def issue(cond: Column, category: str, text: str) -> DataFrame:
        return c.filter(cond).select(
            F.lit(business_date).alias("business_date"), F.lit("CORE_BANKING").alias("source_system"),
            _id("CUST", F.col("c_custkey")).alias("customer_id"), F.lit(category).alias("error_category"),
            F.lit(text).alias("error_description"), ts_literal(as_of).alias("logged_date"),
            F.lit(None).cast("string").alias("execution_id"))

    return issue(F.col("c_acctbal") < 0, "Financial Validation", "Customer overdrawn") \
        .unionByName(issue(F.col("c_mktsegment") == "MACHINERY", "Product Validation", "Segment without products")) \
        .unionByName(issue(F.col("c_mktsegment") == "HOUSEHOLD", "Customer Review", "Review due"))


#: From this date on, the dated configuration of the multi-date run has all bounds of money at a hundredth.
SECOND_VERSION = TREND_DATE - dt.timedelta(days=10)


def dated_bands(spark: SparkSession) -> DataFrame:
    """(effective_from, band_name, minimum_value, maximum_value): the fixed bands, and lower ones from ``SECOND_VERSION``."""
    rows = [(d, b.name, (b.minimum / part).quantize(Decimal("0.01")),
             ((b.maximum + Decimal("0.01")) / part - Decimal("0.01")).quantize(Decimal("0.01")))
            for d, part in ((dt.date(1900, 1, 1), 1), (SECOND_VERSION, 100)) for b in specs.VALUE_BANDS]
    return spark.createDataFrame(rows, "effective_from date, band_name string, minimum_value decimal(18,2), "
                                       "maximum_value decimal(18,2)")


def dated_high_value(spark: SparkSession) -> DataFrame:
    rows = [(dt.date(1900, 1, 1), specs.HIGH_VALUE_MINIMUM), (SECOND_VERSION, specs.HIGH_VALUE_MINIMUM / 100)]
    return spark.createDataFrame(rows, "effective_from date, minimum_value decimal(18,2)")
