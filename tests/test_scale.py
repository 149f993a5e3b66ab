"""What the shared steps may do at any size: passes, shuffles, sorts and stored columns."""

import datetime as dt
import os
import re

import pytest

from pyspark.sql import functions as F

from ledgerlens.operators import kpi, portfolio, reconcile, rules, upsert
from ledgerlens.plans import catalog
from ledgerlens.plans.bank_day import BankDay
from ledgerlens.plans.daily import PORTFOLIO_CHANGE, PORTFOLIO_KEYS
from ledgerlens.session import ensure_checkpoint_dir

SF = "/root/testdata/sf0.001"
DAY = dt.date(2026, 1, 31)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def stored_frames(spark) -> list[str]:
    at = ensure_checkpoint_dir(spark).removeprefix("file:")
    return [n for n in os.listdir(at) if re.match(r"(priced|exceptions|portfolio_rows|branch_exceptions)-", n)]


# --- F8, F13, F15, F17-F20: rules and enrichment --------------------------------

def test_duplicates_are_flagged_in_one_pass(spark, scratch):
    rows = [(DAY, "A", "1", "x"), (DAY, "B", "1", "y"), (DAY, "A", "2", "x"), (dt.date(2026, 1, 30), "A", "2", "x"),
            (DAY, "A", None, "x"), (DAY, "A", None, "x"), (None, "A", "3", "x"), (None, "A", "3", "x")]
    spark.createDataFrame(rows, "business_date date, source_system_code string, source_account_number string, "
                                "customer_id string").write.parquet(f"{scratch}/a")
    flagged = rules.flag_duplicates(spark.read.parquet(f"{scratch}/a"))
    assert plan(flagged).count("FileScan") == 1 and "Join" not in plan(flagged)
    assert flagged.columns[-1] == "is_duplicate"
    found = sorted((str(r[0]), r[1], r[2] or "") for r in flagged.where("is_duplicate").collect())
    assert found == [("2026-01-31", "A", "1"), ("2026-01-31", "B", "1")]
    assert flagged.where("is_duplicate is null").count() == 0 and flagged.count() == len(rows)


def test_exceptions_enrich_accounts_once(spark):
    p = plan(BankDay.from_testdata(spark, SF).exceptions)
    assert "ShuffledHashJoin" in p and "_daily_counts" not in p and "map_from_entries" not in p
    assert p.count("l_linenumber") and len(re.findall(r"FileScan parquet \[l_orderkey", p)) == 1


def test_dedupe_sorts_by_a_hash_first(spark):
    p = plan(BankDay.from_testdata(spark, SF).exceptions)
    assert re.search(r"xxhash64\(business_date#\d+, customer_id#\d+, rule_code#\d+, exception_value#\d+, 42\) AS _w", p)


def test_queries_of_exceptions_alone_store_nothing(spark):
    before = stored_frames(spark)
    catalog.QUERIES["owner_next_due"](spark, SF)
    catalog.QUERIES["exception_sample"](spark, SF)
    assert stored_frames(spark) == before


# --- F1, F2, F11: upserts ---------------------------------------------------------

def accounts(spark, rows):
    types = {"business_date": "date", "account_balance": "decimal(18,2)", "product_count": "int",
             "high_value_customer": "boolean"}
    cols = portfolio.PORTFOLIO_COLUMNS
    return spark.createDataFrame([(r,) for r in rows], "x struct<d: date, c: string, a: string, b: decimal(18,2)>").select(
        *({"business_date": F.col("x.d"), "customer_id": F.col("x.c"), "source_account_number": F.col("x.a"),
           "account_balance": F.col("x.b")}.get(c, F.lit(None)).cast(types.get(c, "string")).alias(c) for c in cols))


def test_null_safe_upsert_moves_no_row_again(spark, scratch):
    from decimal import Decimal
    rows = [(DAY, "c1", "1", Decimal(1)), (DAY, "c1", "1", Decimal(5)), (DAY, None, "1", Decimal(2)),
            (DAY, "c2", None, None)]
    accounts(spark, rows).write.parquet(f"{scratch}/p")
    run = portfolio.one_row_per_account(spark.read.parquet(f"{scratch}/p"), PORTFOLIO_KEYS)
    rest = [c for c in portfolio.PORTFOLIO_COLUMNS if c not in PORTFOLIO_KEYS]
    table = run.where(F.col("customer_id").isNotNull()).withColumn("account_balance", F.lit(5).cast("decimal(18,2)"))
    out = upsert.upsert(table, run, PORTFOLIO_KEYS, PORTFOLIO_CHANGE, rest, null_safe_keys=True, unique_source=True)
    p = plan(out)
    moved = re.findall(r"Exchange hashpartitioning\(([^ ]*)", p.split("== Initial Plan ==")[-1])
    assert len(moved) == 2 and all(m.startswith("xxhash64(") for m in moved) and "SortAggregate" not in p
    found = sorted((r.customer_id or "", r.source_account_number or "", r.account_balance, r._action) for r in out.collect())
    assert found == [("", "1", Decimal(2), "INSERT"), ("c1", "1", Decimal(5), "NOOP"), ("c2", "", None, "UPDATE")]
    twice = run.unionByName(run)
    with pytest.raises(Exception, match="duplicate key"):
        upsert.upsert(table, twice, PORTFOLIO_KEYS, PORTFOLIO_CHANGE, rest, null_safe_keys=True,
                      unique_source=True).collect()


# --- F14: missing and extra rows --------------------------------------------------

def test_missing_extra_sorts_no_side(spark):
    b = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 1)], "k string, n int")
    c = spark.createDataFrame([("a", 1), ("c", 1), (None, 1)], "k string, n int")
    out = reconcile.missing_extra(b, c, ["k", "n"])
    assert "SortMergeJoin" not in plan(out) and "Join" not in plan(out)
    assert sorted((r.k or "", r.row_status) for r in out.collect()) == [
        ("", "EXTRA"), ("", "MISSING"), ("b", "MISSING"), ("c", "EXTRA")]


# --- F3: accounts counted after the join -------------------------------------------

def test_fanout_joins_one_row_per_account(spark):
    p = spark.createDataFrame([(DAY, "S", "1"), (DAY, "T", "1"), (DAY, "S", "2"), (DAY, "S", None), (None, "S", "1")],
                              "business_date date, source_system_code string, source_account_number string")
    e = spark.createDataFrame([(DAY, "1", "HIGH", "h1"), (DAY, "1", "CRITICAL", "h2"), (DAY, "1", "LOW", None),
                               (DAY, None, "HIGH", "h3"), (DAY, "9", "HIGH", "h4")],
                              "business_date date, source_account_number string, severity_code string, exception_hash string")
    out = kpi.source_quality_fanout(p, e)
    assert "SortMergeJoin" not in plan(out)
    found = {(r[0], r[1]): tuple(r)[2:5] for r in out.collect()}
    assert found == {(DAY, "S"): (5, 2, 1), (DAY, "T"): (3, 2, 1), (None, "S"): (1, 0, 0)}


# --- F4-F7, F9, F10, F12, F16: two runs -------------------------------------------

def test_comparisons_store_only_what_they_read_twice(spark):
    b, c = catalog._pair(spark, SF, store=catalog.REPORTED)
    assert b.exceptions.columns == c.exceptions.columns == list(catalog.REPORTED)
    before = set(stored_frames(spark))
    catalog.QUERIES["recon_kpis"](spark, SF)
    assert all(n.startswith("priced-") for n in set(stored_frames(spark)) - before)
    catalog.QUERIES["recon_checks"](spark, SF)
    found = catalog.QUERIES["recon_digest_diff"](spark, SF)
    assert found.columns == ["exception_hash", *reconcile.DETAIL, "row_status"]
    assert not any(n.startswith(("portfolio_rows-", "branch_exceptions-")) for n in set(stored_frames(spark)) - before)


# --- round 4, F1 and F2: exceptions joined by their hash ----------------------------

ACCOUNT = ("business_date date, source_system_code string, source_account_number string, customer_id string, "
           "product_code string, product_description string, currency_code string, rate_missing boolean, "
           "base_currency_balance decimal(18,2), account_status string")


def odd_accounts(spark):
    """Accounts of customers that the master has once, twice and not at all; duplicates on both sides of the inclusion."""
    from decimal import Decimal
    usual = ("SAV001", "Savings", "USD", False, Decimal(5), "ACTIVE")
    closed = ("SAV001", "Savings", "USD", False, Decimal(5), "CLOSED")
    owed = ("SAV001", "Savings", "USD", False, Decimal(-5), "ACTIVE")
    none = ("XX", None, "XXX", True, None, None)
    rows = [(DAY, "S", "1", "once", *usual), (DAY, "T", "1", "once", *closed), (DAY, "S", "2", "twice", *owed),
            (DAY, "S", "3", "absent", *usual), (DAY, "T", "3", "absent", *owed), (DAY, "S", "4", "absent", *none),
            (DAY, "S", "5", None, *none), (DAY, "S", "5", None, *closed), (DAY, "S", None, "once", *owed),
            (DAY, "S", None, "once", *owed), (DAY, "S", None, "twice", *usual), (None, "S", "6", "twice", *owed),
            (DAY, "S", "7", "critical", *owed), (DAY, "T", "7", "once", *usual)]
    return spark.createDataFrame(rows, ACCOUNT)


def odd_master(spark):
    return spark.createDataFrame(
        [(c, "A", n, "STANDARD", "BR001") for c, n in (("once", "1"), ("twice", "1"), ("twice", "2"), (None, "1"), (None, "2"))],
        "customer_id string, first_name string, last_name string, customer_category string, branch_code string")


def rows_of(df, columns=None):
    return sorted((tuple(str(x) for x in r) for r in df.select(*(columns or sorted(df.columns))).collect()))


def test_duplicates_found_before_the_master_is_joined_are_the_same(spark):
    from ledgerlens.sources import config_tables as config
    accounts, master = odd_accounts(spark), odd_master(spark)
    critical = spark.createDataFrame([("critical",)], "customer_id string")
    joined = portfolio.enrich_customer(accounts, master).withColumn("eligible_for_reporting", F.lit("Y"))
    kept = portfolio.include_accounts(joined, critical)
    twice = config.exception_rules(spark).unionByName(config.exception_rules(spark))
    given = (config.exception_rules(spark), config.business_owners(spark), config.exception_severities(spark),
             catalog.testdata.AS_OF)
    early = rules.flag_accounts(portfolio.include_accounts(accounts, critical), master)
    assert rows_of(rules.rule_hits(early)) == rows_of(rules.rule_hits(kept))
    scoped = rules.flag_accounts(portfolio.flag_included(accounts, critical, "kept"), master, "kept")
    found = rules.run_rules_by_content(scoped, twice, *given[1:], "kept")
    for part, rows in zip(found, (joined, kept)):
        expected = rules.run_rules(rows, *given)
        assert expected.count() > 5
        assert rows_of(part.drop(rules.CONTENT)) == rows_of(expected)
    assert rows_of(rules.run_rules_by_content(early, *given)[0].drop(rules.CONTENT)) == rows_of(rules.run_rules(kept, *given))


def test_upsert_of_exceptions_shuffles_both_sides_at_once(spark):
    d = BankDay.from_testdata(spark, SF)
    out = catalog.QUERIES["upsert_exceptions"](spark, SF)
    # nothing is shuffled by the 64 letters of the hash, and what is stays without them
    assert not re.search(r"Exchange hashpartitioning\([^)]*exception_hash", plan(out))
    assert "_scopes" in plan(out) and "xxhash64(concat(" in plan(out)
    rest = [c for c in rules.EXCEPTION_COLUMNS if c not in ("business_date", "exception_hash")]
    assert rows_of(out) == rows_of(upsert.upsert(d.staged_exceptions, d.exceptions, ["business_date", "exception_hash"],
                                          catalog.EXC_CHANGE, rest))


def test_runs_with_other_masters_share_their_shuffles(spark):
    out = catalog.QUERIES["recon_hash_diff"](spark, SF)
    assert not re.search(r"Exchange hashpartitioning\([^)]*exception_hash", plan(out))
    b, c = catalog._pair(spark, SF)
    assert rows_of(out) == rows_of(reconcile.compare_hashes(b.exceptions, c.exceptions))
    moved = [re.sub(r"#\d+L?|plan_id=\d+", "", x) for x in re.findall(
        r"Exchange hashpartitioning\((?:xxhash64\(business_date#\d+, source_account_number|coalesce\(customer_id)[^\n]*", plan(out))]
    assert len(moved) == 4 and len(set(moved)) == 2  # planned a side, and the same for both: run once


def test_joins_beside_a_number_compare_the_keys_themselves(spark):
    t = spark.createDataFrame([(DAY, "A", 1, 7), (DAY, "B", 1, 7), (None, "C", 1, 8)], "d date, k string, v int, near long")
    s = spark.createDataFrame([(DAY, "A", 2, 7), (DAY, "D", 1, 7), (None, "C", 1, 8)], "d date, k string, v int, near long")
    out = upsert.upsert(t, s, ["d", "k"], {"v": 0}, ["v"], beside="near")
    assert out.columns == ["d", "k", "v", "_action"]
    assert rows_of(out) == rows_of(upsert.upsert(t.drop("near"), s.drop("near"), ["d", "k"], {"v": 0}, ["v"]))
    plain = reconcile.compare_hashes(t, s, "k", ["v"])
    assert rows_of(reconcile.compare_hashes(t, s, "k", ["v"], beside="near")) == rows_of(plain)


def test_stored_frames_leave_no_shuffle_behind(spark):
    from ledgerlens.sources import tables

    def left():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.length()) if files.apply(i).getName().startswith("shuffle_")}

    before = left()
    stored = tables.stored(spark.range(1000).withColumn("k", F.col("id") % 10).groupBy("k").count(), "grouped")
    assert not left() - before
    assert stored.count() == 10
