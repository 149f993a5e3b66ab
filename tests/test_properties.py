"""Properties and edge days."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import fixtures as fx
from ledgerlens import specs
from ledgerlens.operators import classify, kpi, portfolio, reconcile, rules, upsert
from ledgerlens.sources import config_tables, extract, sinks
from test_golden import build, exceptions_of


def test_upsert_is_idempotent(spark):
    src = fx.source_tables(spark)
    from ledgerlens.operators import master
    new = master.build_customer_master(extract.extract_customer_ids(src, specs.SOURCES), fx.CAPTURED)
    change = {"customer_status": "", "customer_category": ""}
    cols = ["first_name", "last_name", "customer_category", "branch_code", "customer_status", "last_updated_date"]
    once = upsert.merged(upsert.upsert(fx.master(spark), new, ["customer_id"], change, cols))
    again = upsert.upsert(once, new, ["customer_id"], change, cols)
    assert {r.action for r in upsert.action_metrics(again).collect()} == {"NOOP"}


def test_upsert_delete_and_keep(spark):
    tgt = fx.default_master(spark, ["A", "B", "C"])
    src = fx.default_master(spark, ["B", "D"])
    change = {"customer_status": ""}
    keep = {r.customer_id: r._action for r in upsert.upsert(tgt, src, ["customer_id"], change, []).collect()}
    assert keep == {"A": "KEEP", "B": "NOOP", "C": "KEEP", "D": "INSERT"}
    dele = upsert.upsert(tgt, src, ["customer_id"], change, [], delete_unmatched=True)
    assert sorted(r.customer_id for r in upsert.merged(dele).collect()) == ["B", "D"]
    assert sorted(r.customer_id for r in upsert.delete_stale(tgt, src, ["customer_id"]).collect()) == ["B"]


def test_null_safe_change_detection(spark):
    """NULL -> '' is not a change by default, but is with null_safe=True."""
    t = fx.master(spark, [("X", None, "x", "STANDARD", "BR001")])
    s = fx.master(spark, [("X", "", "x", "STANDARD", "BR001")])
    a = upsert.upsert(t, s, ["customer_id"], {"first_name": ""}, ["first_name"]).first()._action
    b = upsert.upsert(t, s, ["customer_id"], {"first_name": ""}, ["first_name"], null_safe_change=True).first()._action
    assert (a, b) == ("NOOP", "UPDATE")


def test_null_safe_keys(spark):
    """A NULL key only matches a NULL key when asked to."""
    t = spark.createDataFrame([(None, "a")], "k string, v string")
    s = spark.createDataFrame([(None, "b")], "k string, v string")
    strict = upsert.upsert(t, s, ["k"], {"v": ""}, ["v"])
    safe = upsert.upsert(t, s, ["k"], {"v": ""}, ["v"], null_safe_keys=True)
    assert sorted(r._action for r in strict.collect()) == ["INSERT", "KEEP"]
    assert [r._action for r in safe.collect()] == ["UPDATE"]


def test_exceptions_unique_by_hash(spark):
    _, enriched, _ = build(spark, fx.master(spark))
    exc = exceptions_of(spark, enriched)
    assert exc.count() == exc.select("exception_hash").distinct().count()


def test_rules_on_staged_rows_reach_unreachable_rules(spark):
    """DQ002/DQ005 cannot fire on the final portfolio, but do on staged rows."""
    _, enriched, rows = build(spark, fx.master(spark))
    staged_rules = {r.rule_code for r in exceptions_of(spark, enriched).collect()}
    final_rules = {r.rule_code for r in exceptions_of(spark, rows).collect()}
    assert {"DQ002", "DQ005"} <= staged_rules
    assert not ({"DQ002", "DQ003", "DQ005"} & final_rules)


def test_disabled_rule_does_not_fire(spark):
    _, enriched, _ = build(spark, fx.master(spark))
    rules_cfg = config_tables.exception_rules(spark).withColumn(
        "rule_enabled", F.col("rule_code") != "DQ004")
    exc = rules.run_rules(enriched, rules_cfg, config_tables.business_owners(spark),
                          config_tables.exception_severities(spark), fx.LOGGED)
    assert exc.filter("rule_code = 'DQ004'").count() == 0


def test_duplicate_accounts_fire_dq006(spark):
    src = fx.source_tables(spark)
    src["card_accounts"] = src["card_accounts"].unionByName(src["card_accounts"].limit(1))
    staged = extract.extract_accounts(src, specs.SOURCES, business_date=fx.BD)
    enriched = portfolio.stage_accounts(staged, config_tables.exchange_rates(spark),
                                        config_tables.products(spark), fx.master(spark))
    exc = exceptions_of(spark, enriched)
    assert exc.filter("rule_code = 'DQ006'").count() == 1   # two identical rows collapse (Q7)


def test_classification_partition(spark):
    """classified + unclassified + dropped = input."""
    issues = spark.createDataFrame([
        (fx.BD, "CORE_BANKING", "C1", "Customer Validation", "x", fx.LOGGED, None),
        (fx.BD, "CORE_BANKING", "C2", "MISSING_CUSTOMER_ID", "y", fx.LOGGED, None),
        (fx.BD, "LOANS", "C3", "Orphan Category", "z", fx.LOGGED, None),
    ], "business_date date, source_system string, customer_id string, error_category string, "
       "error_description string, logged_date timestamp_ntz, execution_id string")
    cats = config_tables.exception_categories(spark).unionByName(spark.createDataFrame(
        [("Orphan Category", "no severity", "NOPE", "Risk")], config_tables.CATEGORY_SCHEMA))
    out = classify.customer_exceptions(issues, cats, config_tables.exception_severities(spark),
                                       config_tables.business_owners(spark), fx.BD, fx.LOGGED)
    rows = {r.customer_id: r for r in out.collect()}
    assert set(rows) == {"C1", "C2"}   # C3: configured category without severity -> dropped
    assert rows["C1"].severity_code == "HIGH" and rows["C1"].resolution_target_hours == 8
    assert rows["C1"].business_owner == "Customer Services Team" and rows["C1"].escalation_level == 2
    assert rows["C2"].severity_code == "MEDIUM" and rows["C2"].resolution_target_hours == 48
    assert rows["C2"].business_owner == "Data Steward"
    assert rows["C2"].resolution_due_date == fx.LOGGED + dt.timedelta(hours=48)


def test_critical_prefix_and_exclusion(spark):
    issues = spark.createDataFrame([(fx.BD, "LOANS", "CUST004", "Financial Validation", "neg", fx.LOGGED, None)],
                                   "business_date date, source_system string, customer_id string, "
                                   "error_category string, error_description string, "
                                   "logged_date timestamp_ntz, execution_id string")
    ce = classify.customer_exceptions(issues, config_tables.exception_categories(spark),
                                      config_tables.exception_severities(spark),
                                      config_tables.business_owners(spark), fx.BD, fx.LOGGED)
    assert ce.first().exception_description == "[CRITICAL] neg"
    _, enriched, _ = build(spark, fx.master(spark))
    kept = portfolio.include_accounts(enriched, portfolio.critical_customers(ce))
    assert kept.filter("customer_id = 'CUST004'").count() == 0
    assert kept.count() == 17


def test_zero_exception_day(spark):
    _, _, rows = build(spark, fx.master(spark))
    p = portfolio.to_portfolio(rows)
    no_exc = exceptions_of(spark, rows).limit(0)
    card = {r.kpi_name: (r.kpi_value, r.kpi_status) for r in kpi.scorecard(p, no_exc, fx.CAPTURED).collect()}
    assert card["SLA Compliance"] == ("100.00", "GREEN")
    assert card["Critical Exceptions"] == ("0", "GREEN")
    assert card["Exception Rate"] == ("0.00", "GREEN")
    assert card["Portfolio Health"] == ("EXCELLENT", "GREEN")


def test_zero_account_day(spark):
    _, _, rows = build(spark, fx.master(spark))
    p = portfolio.to_portfolio(rows).limit(0)
    exc = exceptions_of(spark, rows)
    h = kpi.health_status(kpi.executive_totals(p, exc)).first()
    assert h.exception_rate is None and h.portfolio_health == "NO DATA"


def test_missing_fx_rate_is_flagged_not_defaulted_silently(spark):
    src = fx.source_tables(spark)
    staged = extract.extract_accounts(src, specs.SOURCES, business_date=fx.BD)
    no_gbp = config_tables.exchange_rates(spark).filter("currency_code <> 'GBP'")
    conv = portfolio.convert_currency(portfolio.cleanse_accounts(staged), no_gbp)
    assert conv.filter("rate_missing").count() == 4     # CB10004, LN10003, MORT003, FX003
    usd_one = conv.filter("source_account_number = 'CB10001'").first()
    assert not usd_one.rate_missing                       # a genuine 1.0 rate is not missing (D4)


def test_recon_against_itself_passes(spark):
    _, _, rows = build(spark, fx.master(spark))
    p = portfolio.to_portfolio(rows)
    exc = exceptions_of(spark, rows)
    card = kpi.scorecard(p, exc, fx.CAPTURED)
    v = reconcile.verdict(reconcile.checks(p, p, exc, exc, card, card)).first()
    assert v.verdict == "PASS" and v.failed_checks == 0


def test_recon_detects_master_change(spark):
    _, _, base_rows = build(spark, fx.master(spark))
    _, _, cur_rows = build(spark, fx.default_master(spark, [c for c, *_ in fx.SEED9] + ["CUST009"]))
    bp, cp = portfolio.to_portfolio(base_rows), portfolio.to_portfolio(cur_rows)
    be, ce = exceptions_of(spark, base_rows), exceptions_of(spark, cur_rows)
    diff = {r.hash_status: r.hash_count for r in reconcile.hash_summary(reconcile.compare_hashes(be, ce)).collect()}
    assert diff == {"BOTH": 7, "BASELINE_ONLY": 1}
    checks = {r.check_name: r for r in reconcile.checks(bp, cp, be, ce, kpi.scorecard(bp, be, fx.CAPTURED),
                                                         kpi.scorecard(cp, ce, fx.CAPTURED)).collect()}
    assert not checks["exception_hashes"].passed
    assert checks["exception_hashes"].explanation.startswith("check exception_hashes failed")
    assert checks["portfolio_balance"].passed
    assert reconcile.verdict(spark.createDataFrame(list(checks.values()))).first().verdict == "FAIL"


def test_kpi_loose_compare(spark):
    b = spark.createDataFrame([("Exception Rate", "42.11%", "RED"), ("SLA Compliance", "0.000000", "red"),
                               ("Portfolio Health", "POOR", "RED")], "kpi_name string, kpi_value string, kpi_status string")
    c = spark.createDataFrame([("Exception Rate", "42.11", "RED"), ("SLA Compliance", "0.00", "RED"),
                               ("Portfolio Health", "poor", "AMBER")], "kpi_name string, kpi_value string, kpi_status string")
    rows = {r.kpi_name: r for r in reconcile.compare_kpis(b, c).collect()}
    assert all(r.value_match for r in rows.values())
    assert rows["SLA Compliance"].status_match and not rows["Portfolio Health"].status_match


def test_replace_date_with_empty_rows_removes_the_date(spark):
    t = spark.createDataFrame([(fx.BD, "a"), (fx.BD - dt.timedelta(days=1), "b")], "business_date date, v string")
    out = upsert.replace_date(t, t.limit(0), fx.BD)
    assert [r.v for r in out.collect()] == ["b"]


def test_assert_unique_catches_duplicated_owner(spark):
    owners = config_tables.business_owners(spark)
    upsert.assert_unique(owners, ["business_area"], "business_owner")
    with pytest.raises(ValueError):
        upsert.assert_unique(owners.unionByName(owners.limit(1)), ["business_area"], "business_owner")


def test_extraction_guards(spark):
    src = fx.source_tables(spark)
    with pytest.raises(ValueError):
        extract.check_load_type("DELTA")
    with pytest.raises(ValueError):
        extract.active_specs([s for s in specs.SOURCES if False])
    broken = dict(src)
    broken["loan_accounts"] = src["loan_accounts"].drop("loan_status")
    with pytest.raises(ValueError):
        extract.extract_accounts(broken, specs.SOURCES, business_date=fx.BD)


def test_incremental_drops_closed_before_upper_casing(spark):
    src = fx.source_tables(spark)
    src["card_accounts"] = src["card_accounts"].withColumn(
        "card_status", F.when(F.col("card_account_number") == "CARD001", "closed").otherwise(F.col("card_status")))
    inc = extract.extract_accounts(src, specs.SOURCES, business_date=fx.BD, load_type="INCREMENTAL")
    accts = {r.source_account_number for r in inc.collect()}
    assert "CB10008" not in accts and "MORT003" not in accts and "CARD001" in accts
    assert len(accts) == 27


def test_other_dates_are_ignored(spark):
    src = fx.source_tables(spark, date=fx.BD - dt.timedelta(days=1))
    assert extract.extract_accounts(src, specs.SOURCES, business_date=fx.BD).count() == 0


def test_headerless_csv_roundtrip(spark, scratch):
    path = f"{scratch}/golden.csv"
    with open(path, "w", encoding="utf-8") as f:
        f.write("﻿2026-01-31,Exception Rate,42.11,RED\n2026-01-31,Critical Exceptions,NULL,GREEN\nbroken\n")
    df = sinks.read_headerless_csv(spark, path, [("business_date", "date"), ("kpi_name", "string"),
                                                 ("kpi_value", "string"), ("kpi_status", "string")])
    rows = df.filter(F.col("business_date").isNotNull()).collect()
    assert rows[0].business_date == fx.BD and rows[0].kpi_value == "42.11"
    assert rows[1].kpi_value is None


def test_sinks_and_snapshot(spark, scratch):
    _, _, rows = build(spark, fx.master(spark))
    p = portfolio.to_portfolio(rows)
    sinks.append(p, f"{scratch}/portfolio")
    sinks.overwrite_dates(p.limit(3), f"{scratch}/portfolio")
    assert spark.read.parquet(f"{scratch}/portfolio").count() == 3
    sinks.snapshot(p, f"{scratch}/snap", fx.CAPTURED)
    assert spark.read.parquet(f"{scratch}/snap").select("baseline_capture_date").distinct().count() == 1
    counts = {r.table_name: r.row_count for r in sinks.table_counts({"p": p, "e": p.limit(2)}).collect()}
    assert counts == {"p": 19, "e": 2}


def test_rate_rounding_half_up(spark):
    from ledgerlens.functions.expressions import percent
    df = spark.createDataFrame([(1, 8), (1, 3), (2, 3), (0, 0)], "n long, d long")
    got = [r.r for r in df.select(percent("n", "d").alias("r")).collect()]
    assert got == [Decimal("12.50"), Decimal("33.33"), Decimal("66.67"), None]
