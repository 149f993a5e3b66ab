"""The daily run, its guards and the history modes."""

import datetime as dt

import fixtures as fx
import pytest
from pyspark.sql import functions as F

from ledgerlens import specs
from ledgerlens.operators import kpi, portfolio, runlog, upsert
from ledgerlens.plans.bank_day import BankDay
from ledgerlens.plans.daily import check_lookups, read_table, run_daily
from ledgerlens.sources import config_tables, extract, sinks

TABLES = ("customer_master", "data_quality_issues", "customer_exceptions", "customer_exception_summary",
          "customer_portfolio", "portfolio_errors", "portfolio_exceptions", "exception_area_summary",
          "exception_report", "executive_dashboard")


def make_day(spark, **kw):
    return BankDay(spark, fx.source_tables(spark), fx.master(spark), business_date=fx.BD, as_of=fx.LOGGED,
                   execution_id="R1", **kw)


def rows_of(spark, base, name):
    df = read_table(spark, base, name)
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_running_the_day_twice_leaves_the_same_tables(spark, scratch):
    base = f"{scratch}/bank"
    run_daily(make_day(spark), base)
    first = {n: rows_of(spark, base, n) for n in TABLES}
    run_daily(make_day(spark), base)
    assert {n: rows_of(spark, base, n) for n in TABLES} == first
    assert len(first["customer_portfolio"]) == 19 and len(first["exception_report"]) == 4
    log = runlog.newest_runs(spark.read.parquet(f"{base}/run_log")).collect()
    assert [r.status for r in log] == ["SUCCESS"] * 5
    assert {r.procedure_name for r in log} == set(runlog.STAGES)
    assert [r.start_time for r in log] == sorted((r.start_time for r in log), reverse=True)


def test_a_failed_stage_is_logged_whole_and_leaves_its_table(spark, scratch):
    base = f"{scratch}/bank"
    run_daily(make_day(spark), base)
    before = rows_of(spark, base, "portfolio_exceptions")
    bad = make_day(spark)
    long = "x" * 900
    bad.materialize = lambda: None
    bad.__dict__["branch_exceptions"] = bad.branch_exceptions.withColumn(
        "branch_code", F.raise_error(F.lit(long)).cast("string"))
    bad.__dict__["exceptions"] = bad.branch_exceptions.withColumn("customer_id", F.col("branch_code")).drop("branch_code")
    with pytest.raises(Exception, match="xxx"):
        run_daily(bad, base)
    assert rows_of(spark, base, "portfolio_exceptions") == before
    failed = spark.read.parquet(f"{base}/run_log").filter("status = 'FAILED'").collect()
    assert len(failed) == 1 and long in failed[0].message and failed[0].procedure_name == runlog.STAGES[3]


@pytest.mark.parametrize("mode, kept", [("replace", 1), ("accumulate", 2)])
def test_exception_history_modes(spark, scratch, mode, kept):
    """An exception that a second run of the date no longer finds stays only when history accumulates."""
    base = f"{scratch}/bank"
    run_daily(make_day(spark), base)
    assert read_table(spark, base, "portfolio_exceptions").filter("exception_value = 'CUST020'").count() == 1
    again = make_day(spark, master_sources=None)
    run_daily(again, base, history=mode)
    hashes = read_table(spark, base, "portfolio_exceptions")
    assert hashes.count() == hashes.select("exception_hash").distinct().count()
    assert hashes.filter("exception_value = 'CUST020'").count() == kept - 1
    with pytest.raises(ValueError):
        run_daily(again, base, history="other")


def test_rates_of_the_day_are_required(spark):
    day = make_day(spark)
    day.__dict__["fx"] = day.fx.withColumn("effective_date", F.date_add("effective_date", 1))
    with pytest.raises(ValueError, match="no exchange rates"):
        check_lookups(day)


@pytest.mark.parametrize("name, change", [
    ("fx", lambda df: df.unionByName(df.filter("currency_code = 'EUR'").withColumn("currency_code", F.lit("eur")))),
    ("products", lambda df: df.unionByName(df.limit(1))), ("owners", lambda df: df.unionByName(df.limit(1))),
    ("severities", lambda df: df.unionByName(df.limit(1))), ("categories", lambda df: df.unionByName(df.limit(1))),
    ("rules_config", lambda df: df.unionByName(df.limit(1)))])
def test_duplicated_lookups_are_refused(spark, name, change):
    check_lookups(make_day(spark))
    day = make_day(spark)
    day.__dict__[name] = change(getattr(day, name))
    with pytest.raises(ValueError, match="duplicate keys"):
        check_lookups(day)


def test_upsert_refuses_a_source_key_that_occurs_twice(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    twice = spark.createDataFrame([(1, "b"), (1, "c")], "k int, v string")
    with pytest.raises(Exception, match="duplicate key"):
        upsert.upsert(t, twice, ["k"], {"v": ""}, ["v"], unique_source=True).collect()
    once = upsert.upsert(t, twice.limit(1), ["k"], {"v": ""}, ["v"], unique_source=True).collect()
    assert [(r.k, r.v, r._action) for r in once] == [(1, "b", "UPDATE")]


def test_product_count_is_per_date(spark):
    src = fx.source_tables(spark)
    earlier = fx.BD - dt.timedelta(days=1)
    col = {s.table: s.date for s in specs.SOURCES}
    both = {t: df.unionByName(df.withColumn(col[t], F.lit(earlier))) for t, df in src.items()}
    both["loan_accounts"] = src["loan_accounts"]
    rates = config_tables.exchange_rates(spark)
    rates = rates.unionByName(rates.withColumn("effective_date", F.lit(earlier)))
    staged = extract.extract_accounts(both, specs.SOURCES, date_range=(earlier, fx.BD))
    enriched = portfolio.stage_accounts(staged, rates, config_tables.products(spark), fx.master(spark))
    for rows in (enriched, enriched.drop("product_count")):
        p = portfolio.add_portfolio_metrics(portfolio.include_accounts(rows, None))
        counts = {(r.business_date, r.customer_id): r.n for r in p.groupBy("business_date", "customer_id").agg(
            F.count(F.lit(1)).alias("n")).collect()}
        got = {(r.business_date, r.customer_id): r.product_count for r in p.collect()}
        assert got == counts and got[(fx.BD, "CUST001")] == got[(earlier, "CUST001")] + 1


def test_versions_switch(spark, scratch):
    base = f"{scratch}/t"
    assert sinks.current_version(spark, base) is None
    for n in (1, 2):
        sinks.write_then_switch(spark.range(n), base, f"v{n}")
        assert spark.read.parquet(sinks.current_version(spark, base)).count() == n


def test_latest_event_wins_ties_by_status(spark):
    at = fx.LOGGED
    events = runlog.event_row(spark, "R", "s", fx.BD, "FULL", "FAILED", at).unionByName(
        runlog.event_row(spark, "R", "s", fx.BD, "FULL", "RUNNING", at))
    assert runlog.latest(events).first().status == "FAILED"


def test_config_rows_drive_bands_thresholds_and_sources(spark):
    bands = config_tables.bands_from_config(config_tables.value_bands(spark).withColumn(
        "minimum_value", F.when(F.col("band_name") == "PLATINUM", F.lit(0).cast("decimal(18,2)") + 900000)
        .otherwise(F.col("minimum_value"))))
    df = spark.createDataFrame([("950000.00",)], "v string").select(F.col("v").cast("decimal(18,2)").alias("base_currency_balance"),
                                                                    F.lit(fx.BD).alias("business_date"), F.lit("C").alias("customer_id"))
    assert portfolio.add_portfolio_metrics(df, bands).first().portfolio_value_band == "PLATINUM"
    assert portfolio.add_portfolio_metrics(df).first().portfolio_value_band == "GOLD"
    strict = config_tables.thresholds_from_config(config_tables.reporting_thresholds(spark).withColumn(
        "green_threshold", F.lit(0).cast("decimal(18,2)")).withColumn("amber_threshold", F.lit(0).cast("decimal(18,2)")))
    day = make_day(spark, thresholds=strict)
    status = {r.kpi_name: r.kpi_status for r in day.scorecard.collect()}
    assert status["Critical Exceptions"] == "RED"
    assert {r.kpi_name: r.kpi_status for r in make_day(spark).scorecard.collect()}["Critical Exceptions"] == "GREEN"
    one = config_tables.source_configuration(spark).filter("source_system_code = 'LOANS'")
    day = make_day(spark, source_specs=config_tables.source_specs_from_config(one))
    assert {r.source_system_code for r in day.staged.collect()} == {"LOANS"}


def test_incremental_extraction_differs_from_full(spark):
    """Closed accounts leave an incremental load."""
    full, inc = make_day(spark).staged, make_day(spark, load_type="INCREMENTAL").staged
    assert full.count() - inc.count() == full.filter("account_status = 'CLOSED'").count() > 0


def test_verify_deleted(spark):
    t = spark.createDataFrame([(fx.BD, "a")], "business_date date, v string")
    with pytest.raises(RuntimeError):
        upsert.verify_deleted(t, fx.BD)
    upsert.verify_deleted(upsert.replace_date(t, t.limit(0), fx.BD), fx.BD)


def test_kpis_pair_by_date(spark):
    rows = [(fx.BD - dt.timedelta(days=k), "Exception Rate", str(k), "RED") for k in range(3)]
    b = spark.createDataFrame(rows, "business_date date, kpi_name string, kpi_value string, kpi_status string")
    from ledgerlens.operators import reconcile
    out = reconcile.compare_kpis(b, b).collect()
    assert len(out) == 3 and all(r.value_match for r in out)


def test_report_totals_equal_the_separate_aggregates(spark):
    day = make_day(spark)
    a = kpi.executive_totals(day.portfolio, day.exceptions).first()
    b = kpi.report_totals(day.portfolio, day.exceptions, day.report_as_of).first()
    assert all(a[c] == b[c] for c in a.asDict())


# --- versioned tables ---------------------------------------------------------

def files_of(table, part):
    return sorted(f for f in table.read([part]).inputFiles())


def later(spark, days, **kw):
    """The fixture's day, ``days`` later."""
    move = {s.table: s.date for s in specs.SOURCES}
    src = {t: df.withColumn(move[t], F.date_add(move[t], days)) for t, df in fx.source_tables(spark).items()}
    d = BankDay(spark, src, fx.master(spark), business_date=fx.BD + dt.timedelta(days=days),
                as_of=fx.LOGGED + dt.timedelta(days=days), execution_id=f"R{days}", **kw)
    d.__dict__["fx"] = d.fx.withColumn("effective_date", F.date_add("effective_date", days))
    return d


def test_three_days_leave_earlier_dates_alone_and_remember_critical_customers(spark, scratch):
    from ledgerlens.plans.daily import dated_table, master_table
    base = f"{scratch}/bank"
    issue = ("CUST002", "Financial Validation", "frozen account")
    first = make_day(spark)
    shape = first.data_quality_issues
    row = shape.limit(1).withColumn("customer_id", F.lit(issue[0])).withColumn("error_category", F.lit(issue[1])) \
        .withColumn("error_description", F.lit(issue[2]))
    first = make_day(spark, extra_issues=row)
    run_daily(first, base)
    held = read_table(spark, base, "customer_exceptions").filter("customer_id = 'CUST002'").collect()
    assert [(r.severity_code, r.exception_status) for r in held] == [("CRITICAL", "OPEN")]
    dated = [n for n in TABLES if n != "customer_master"]
    before = {n: files_of(dated_table(spark, base, n), fx.BD) for n in dated}
    master_files = sorted(master_table(spark, base).read().inputFiles())
    for k in (1, 2):
        run_daily(later(spark, k), base)
    assert {n: files_of(dated_table(spark, base, n), fx.BD) for n in dated} == before
    # the same customers come in every day: no bucket of the master is written again
    assert sorted(master_table(spark, base).read().inputFiles()) == master_files
    rows = read_table(spark, base, "customer_portfolio")
    assert {r.business_date for r in rows.select("business_date").distinct().collect()} == {
        fx.BD + dt.timedelta(days=k) for k in range(3)}
    assert rows.filter("customer_id = 'CUST002'").count() == 0 < rows.filter("customer_id = 'CUST001'").count()


def test_the_log_holds_the_counts_of_what_was_written(spark, scratch):
    base = f"{scratch}/bank"
    day = make_day(spark)
    run_daily(day, base)
    log = {r.procedure_name: r for r in runlog.latest(spark.read.parquet(f"{base}/run_log")).collect()}
    fresh = make_day(spark)
    master = {r.action: r.row_count for r in upsert.action_metrics(fresh.master_upsert).collect()}
    one = log[runlog.STAGES[0]]
    assert (one.rows_read, one.rows_inserted, one.rows_updated, one.rows_rejected) == (
        fresh.customer_ids.count(), master.get("INSERT", 0), master.get("UPDATE", 0), fresh.data_quality_issues.count())
    two = log[runlog.STAGES[2]]
    assert (two.rows_read, two.rows_inserted, two.rows_updated) == (fresh.staged.count(), 19, 0)
    assert two.rows_rejected == read_table(spark, base, "portfolio_errors").count()
    assert (log[runlog.STAGES[3]].rows_read, log[runlog.STAGES[3]].rows_inserted) == (19, fresh.exceptions.count())
    assert log[runlog.STAGES[4]].rows_inserted == 4
    # the same day again: nothing is new in the merged tables
    run_daily(make_day(spark), base)
    again = {r.procedure_name: r for r in runlog.latest(spark.read.parquet(f"{base}/run_log")).collect()}
    assert [(again[s].rows_inserted, again[s].rows_updated) for s in runlog.STAGES[:3]] == [(0, 0)] * 3


def test_customer_exceptions_are_merged_by_date_customer_and_category(spark, scratch):
    from ledgerlens.plans.daily import dated_table
    base = f"{scratch}/bank"
    run_daily(make_day(spark), base)
    table = dated_table(spark, base, "customer_exceptions")
    held = table.read()
    other = held.withColumn("business_owner", F.lit("Reassigned")).withColumn("assigned_date", F.to_timestamp_ntz(F.lit("2020-01-01 00:00:00"))
                                                                              .cast(held.schema["assigned_date"].dataType))
    extra = other.limit(1).withColumn("customer_id", F.lit("OLD"))
    table.replace(other.unionByName(extra), [fx.BD])
    run_daily(make_day(spark), base)
    rows = read_table(spark, base, "customer_exceptions").collect()
    assert sorted(r.business_owner == "Reassigned" for r in rows) == [False] * (len(rows) - 1) + [True]
    assert {str(r.assigned_date)[:4] for r in rows} == {"2020"}, "a merged row keeps the date it was assigned"


def test_a_killed_run_goes_on_at_its_first_unfinished_stage(spark, scratch, monkeypatch):
    from ledgerlens.plans import daily
    base = f"{scratch}/bank"

    class Killed(BaseException):
        """No event is written, as when the driver dies."""

    def dies(self, counts):
        raise Killed
    with monkeypatch.context() as m:
        m.setattr(daily.DailyRun, "load_customer_portfolio", dies)
        with pytest.raises(Killed):
            run_daily(make_day(spark), base)
    status = {r.procedure_name: r.status for r in runlog.latest(spark.read.parquet(f"{base}/run_log")).collect()}
    assert status == {runlog.STAGES[0]: "SUCCESS", runlog.STAGES[1]: "SUCCESS", runlog.STAGES[2]: "RUNNING"}
    assert run_daily(make_day(spark), base, resume=True) == list(runlog.STAGES[2:])
    log = spark.read.parquet(f"{base}/run_log")
    assert log.filter("status = 'FAILED' and message like 'closed by a later run%'").count() == 1
    latest = {r.procedure_name: r for r in runlog.latest(log).collect()}
    assert {r.status for r in latest.values()} == {"SUCCESS"} and len(latest) == 5
    assert len(rows_of(spark, base, "customer_portfolio")) == 19
    assert run_daily(make_day(spark), base, resume=True) == []
    # a table that somebody changed is loaded again, and all after it
    daily.dated_table(spark, base, "portfolio_errors").replace(read_table(spark, base, "portfolio_errors").limit(0), [fx.BD])
    assert run_daily(make_day(spark), base, resume=True) == list(runlog.STAGES[2:])


def test_a_dated_table_replaces_only_what_it_is_told(spark, scratch):
    from ledgerlens.sources.tables import CommitConflict, DatedTable
    one, two, three = (fx.BD + dt.timedelta(days=k) for k in range(3))
    t = DatedTable(spark, f"{scratch}/t")
    assert t.read() is None and t.dates() == []

    def rows(*pairs):
        return spark.createDataFrame(list(pairs), "business_date date, v int")
    t.replace(rows((one, 1), (two, 2), (None, 3)), [one, two, None])
    start = t.current()
    kept = files_of(t, one)
    t.replace(rows((two, 20), (two, 21)), [two])
    t.replace(rows(), [None, three])
    assert files_of(t, one) == kept and t.dates() == [str(one), str(two)]
    assert sorted(r.v for r in t.read().collect()) == [1, 20, 21] and t.read([three]).count() == 0
    assert "InMemoryFileIndex(1 paths)" in t.read([two])._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="not replaced"):
        t.replace(rows((one, 1), (two, 2)), [one])
    with pytest.raises(ValueError, match="columns differ"):
        t.replace(rows((one, 1)).withColumn("w", F.lit(1)), [one])
    # a load made from an older table goes through for its own date, and is refused for one changed since
    t.replace(rows((three, 5)), [three], start)
    with pytest.raises(CommitConflict):
        t.replace(rows((two, 6)), [two], start)
    assert sorted(r.v for r in t.read().collect()) == [1, 5, 20, 21]
    t.verify(two, 2)
    with pytest.raises(RuntimeError, match="2 rows"):
        t.verify(two, 0)
    gone = t.expire(keep=1)
    assert gone and sorted(r.v for r in t.read().collect()) == [1, 5, 20, 21] and files_of(t, one) == kept


def test_two_loads_of_one_number_cannot_both_commit(spark, scratch):
    from ledgerlens.sources.tables import Manifest, VersionedTable
    t = VersionedTable(spark, f"{scratch}/t")
    assert t._publish(Manifest(1, {"a": "x"}, "")) and not t._publish(Manifest(1, {"a": "y"}, ""))
    assert t.current().parts == {"a": "x"} and t._names("drafts") == []


def test_a_bucketed_upsert_moves_no_target_row_and_keeps_unchanged_buckets(spark, scratch):
    from ledgerlens.sources.tables import BucketedTable
    t = BucketedTable(spark, f"{scratch}/m", ["k"], 6)
    rows = spark.range(500).selectExpr("concat('C', id) k", "cast(id % 7 as string) v", "'old' as name")
    t.load(rows)
    source = spark.createDataFrame([("C5", "x", "new"), ("C6", "6", "new"), ("N1", "y", "new")], "k string, v string, name string")
    plan = upsert.upsert(t.read(), t.aligned(source), ["k"], {"v": ""}, ["v", "name"], unique_source=True) \
        ._jdf.queryExecution().executedPlan().toString()
    target_side, source_side = plan.split("Aggregate", 1)
    assert "Bucketed: true" in target_side and "SortMergeJoin" in target_side and "Exchange" not in target_side
    assert source_side.count("Exchange") == 1
    before = t.current().parts
    done = t.upsert(source, {"v": ""}, ["v", "name"])
    assert done == {"INSERT": 1, "UPDATE": 1, "NOOP": 1, "DELETE": 0, "KEEP": 498}
    spots = {r.b for r in source.where("k <> 'C6'").select(t.bucket().alias("b")).collect()}
    assert {int(p) for p, f in t.current().parts.items() if before[p] != f} == spots
    want = {(f"C{i}", str(i % 7), "old") for i in range(500) if i != 5} | {("C5", "x", "new"), ("N1", "y", "new")}
    assert {tuple(r) for r in t.read().collect()} == want
    again = t.current()
    assert t.upsert(source, {"v": ""}, ["v", "name"])["NOOP"] == 3 and t.current() == again
    gone = t.upsert(source, {"v": ""}, ["v", "name"], delete_unmatched=True)
    assert gone["DELETE"] == 498 and t.read().count() == 3
    with pytest.raises(Exception, match="duplicate key"):
        t.upsert(source.unionByName(source), {"v": ""}, ["v", "name"])


def test_no_reading_of_an_upsert_passes_over_a_repeated_source_key(spark):
    t = spark.createDataFrame([(1, "a", "p")], "k int, v string, w string")
    twice = spark.createDataFrame([(1, "b", "q"), (1, "b", "r")], "k int, v string, w string")
    keys = t.select("k")
    for make in (lambda: upsert.action_metrics(upsert.upsert(t, twice, ["k"], {"w": ""}, ["v"], unique_source=True)),
                 lambda: upsert.upsert(t, twice, ["k"], {"w": ""}, ["v"], unique_source=True).select("k", "_action"),
                 lambda: upsert.upsert(t, twice, ["k"], {"w": ""}, ["v"], unique_source=True).select("k"),
                 lambda: upsert.upsert(keys, twice.select("k"), ["k"], {}, [], unique_source=True)):
        with pytest.raises(Exception, match="duplicate key"):
            make().collect()


# --- rollup, digests, rejects ---------------------------------------------------

def test_a_trend_from_the_rollup_equals_the_recomputed_one(spark, scratch):
    from ledgerlens.plans.rollup import ExceptionRollup
    days = [fx.BD - dt.timedelta(days=k) for k in range(40)]
    rows = [(d, ("CRITICAL", "HIGH", "LOW")[i % 3], (None, "A", "B")[(i + d.day) % 3]) for d in days for i in range(d.day % 5)]
    schema = "business_date date, severity_code string, business_owner string"
    df = spark.createDataFrame(rows, schema)
    r = ExceptionRollup(spark, f"{scratch}/rollup")
    with pytest.raises(ValueError):
        r.trend(fx.BD)

    def same(frame):
        assert sorted(map(tuple, r.trend(fx.BD).collect())) == sorted(map(tuple, kpi.trend(frame, fx.BD).collect()))
    r.update(df, days)
    same(df)
    kept = {d: files_of(r.table, d) for d in days[2:] if str(d) in r.table.dates()}
    # one date replaced, one emptied
    changed = df.where(~F.col("business_date").isin(days[:2])).unionByName(
        spark.createDataFrame([(days[0], "CRITICAL", "C"), (days[0], "LOW", "C")], schema))
    r.update(changed, days[:2])
    same(changed)
    assert {d: files_of(r.table, d) for d in kept} == kept
    assert len(r.trend(fx.BD).inputFiles()) <= 31


def affected_rows(n, first=0):
    days = [fx.BD - dt.timedelta(days=k) for k in range(5)]
    return [(days[i % 5], ("HIGH", "LOW", None)[i % 3], "ABC"[i % 2], None if i % 11 == 0 else f"C{(i * i) % 61}",
             "S1" if i % 7 else None, f"A{i % 37}") for i in range(first, first + n)]


AFFECTED_SCHEMA = ("business_date date, severity_code string, business_area string, customer_id string, "
                   "source_system_code string, source_account_number string")


def brute_affected(rows, by):
    names = ("business_date", "severity_code", "business_area")
    groups = {}
    for r in rows:
        groups.setdefault(tuple(r[names.index(b)] for b in by), []).append(r)
    return {k: (len(g), len({r[3] for r in g if r[3]}), len({r[4:6] for r in g if r[4] and r[5]}))
            for k, g in groups.items()}


def test_distinct_counts_merge_over_dates_and_groups(spark, scratch):
    from ledgerlens.operators import rules
    from ledgerlens.plans.rollup import AffectedRollup
    days = [fx.BD - dt.timedelta(days=k) for k in range(5)]
    r = AffectedRollup(spark, f"{scratch}/affected", buckets=3)
    with pytest.raises(ValueError):
        r.counts()
    rows = affected_rows(400)

    def found(dates, by):
        return {tuple(x[b] for b in by): (x.exception_count, x.customers_affected, x.accounts_affected)
                for x in r.counts(dates, by).collect()}
    r.update(spark.createDataFrame(rows, AFFECTED_SCHEMA), days[1:])
    kept = {d: files_of(r.table, d) for d in days[2:]}
    old = {x.customer_id: x.number for x in r.numbers["customers_affected"].table.read().collect()}
    # a new date with new keys and a replaced date
    rows = [x for x in rows if x[0] != days[1]] + [
        (d, "HIGH", "A", f"N{i}", "S2", f"A{i}") for i in range(40) for d in days[:2]]
    df = spark.createDataFrame(rows, AFFECTED_SCHEMA)
    r.update(df, days[:2])
    assert {d: files_of(r.table, d) for d in kept} == kept
    now = {x.customer_id: x.number for x in r.numbers["customers_affected"].table.read().collect()}
    assert old.items() <= now.items() and len(now) >= len(old) + 40
    for by in (AffectedRollup.GROUPS, ("severity_code", "business_area"), ("business_date",), ("business_area",)):
        assert found(None, by) == brute_affected(rows, by)
    assert found(days[:2], ()) == brute_affected([x for x in rows if x[0] in days[:2]], ())
    # the dashboard of a recomputation, without its Expand
    dash = rules.severity_area_dashboard(df)
    assert sorted(map(str, r.counts().select(*dash.columns).collect())) == sorted(map(str, dash.collect()))
    assert "Expand" not in r.counts()._jdf.queryExecution().executedPlan().toString()


def test_numbers_of_keys_are_unique_lasting_and_refused_to_two_loads(spark, scratch):
    from ledgerlens.operators.distinct import KeyNumbers, states
    from ledgerlens.sources.tables import CommitConflict
    k = KeyNumbers(spark, f"{scratch}/keys", ["k"], 2)
    assert k.extend(spark.createDataFrame([], "k string, other int")) == 0
    assert k.extend(spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), (None, 4)], "k string, other int")) == 2
    before = k.table.current()
    more = spark.range(70_000).selectExpr("cast(id as string) k", "id % 2 = 0 as g", "1 as number", "2 as bucket")
    assert k.extend(more) == 70_000 and k.extend(more) == 0
    assert k.table.read().groupBy(k.table.bucket(), "number").count().where("count > 1").isEmpty()
    # columns of the rows may have the names used here; both chunks of a bucket count
    got = states(more, ["g", "number"], k).groupBy("g", "number").agg(F.sum(F.bitmap_count("bits")))
    assert sorted(map(tuple, got.collect())) == [(False, 1, 35_000), (True, 1, 35_000)]
    assert states(more, [], k).select("chunk").distinct().count() == 2
    with pytest.raises(CommitConflict):
        k.table.upsert(spark.createDataFrame([("z", 3), ("y", 3), ("x", 3)], "k string, number long"), {"number": 0},
                       ["number"], read=before)
    # where the numbers are too many to broadcast, they stay in their buckets
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    joined = k.of(more.select("k"))._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert joined.count("Exchange") == 1 and "SortMergeJoin" in joined and "Bucketed: true" in joined


def test_digests_find_the_rows_of_one_side(spark):
    from ledgerlens.operators import digests
    rows = [(i if i % 9 else None, f"v{i % 50}", i) for i in range(400)]
    b = spark.createDataFrame(rows, "k int, v string, n int")
    other = [r for r in rows if r[2] not in (7, 8, 300)] + [(7777, "new", 1), (None, "vx", 2)]
    c = spark.createDataFrame(list(reversed(other)), "k int, v string, n int")
    keys = ["k", "v"]
    held = {(r[0], r[1]) for r in rows}, {(r[0], r[1]) for r in other}
    want = sorted([(*x, "MISSING") for x in held[0] - held[1]] + [(*x, "EXTRA") for x in held[1] - held[0]], key=repr)
    for leaves in (1, 8, 4096):
        got = digests.one_sided(b, c, keys, leaves=leaves).distinct().collect()
        assert sorted(map(tuple, got), key=repr) == want
    one, two = (digests.leaf_digests(x, keys, b.columns, 64) for x in (b, b.orderBy(F.rand(3))))
    assert digests.differing_leaves(one, two, 8).count() == 0
    assert digests.one_sided(b, b, keys).count() == 0
    # a changed value and a repeated row show in the leaf of their key, and in no other
    moved = b.withColumn("n", F.when(F.col("n") == 20, -1).otherwise(F.col("n"))).unionByName(b.where("n = 30"))
    spots = {r.leaf for r in digests.differing_leaves(one, digests.leaf_digests(moved, keys, b.columns, 64), 8).collect()}
    assert spots == {r.leaf for r in b.where("n in (20, 30)").select(digests.leaf_of(keys, 64).alias("leaf")).collect()}
    empty = b.limit(0)
    assert digests.one_sided(empty, empty, keys).count() == 0
    assert digests.one_sided(empty, b.where("k = 1"), keys).first().row_status == "EXTRA"


def test_equal_runs_are_compared_without_joining_rows(spark, scratch):
    """Only digests travel: rows are filtered by the leaves that differ before they are shuffled."""
    from ledgerlens.operators import digests
    spark.range(20_000).selectExpr("id k", "cast(id as string) v").write.parquet(f"{scratch}/b")
    one = spark.read.parquet(f"{scratch}/b")
    plan = digests.one_sided(one, one, ["k"], ["k", "v"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("BroadcastHashJoin [leaf") >= 4 and "LeftSemi" in text and plan.count() == 0


def test_unreadable_lines_become_issues(spark, scratch):
    path = f"{scratch}/x.csv"
    with open(path, "w", encoding="utf-8") as f:
        f.write("\ufeff2026-01-31,A,1.50\n2026-01-31,B,NULL\n2026-13-99,C,2.00\n2026-01-31,D,abc\nbroken\n"
                "2026-01-31,E,3,more\n2026-01-31,,4.25\n")
    columns = [("business_date", "date"), ("code", "string"), ("amount", "decimal(18,2)")]
    good = sinks.read_headerless_csv(spark, path, columns)
    assert [f.dataType.simpleString() for f in good.schema] == ["date", "string", "decimal(18,2)"]
    assert sorted((r.code or "", str(r.amount)) for r in good.collect()) == [("", "4.25"), ("A", "1.50"), ("B", "None")]
    bad = sinks.csv_rejects(spark, path, columns, "EXPORT", fx.BD, fx.LOGGED, "R1")
    assert bad.columns == make_day(spark).data_quality_issues.columns
    assert sorted(r.error_description for r in bad.collect()) == [
        "Line with another number of fields: 2026-01-31,E,3,more", "Line with another number of fields: broken",
        "Values of another type: amount=abc", "Values of another type: business_date=2026-13-99"]


# --- dated ladders ----------------------------------------------------------------

def test_dated_ladders_follow_the_date_and_the_bounds(spark):
    from decimal import Decimal as D

    from ledgerlens.functions.intervals import DatedLadder, Step
    one, two = dt.date(2025, 1, 1), dt.date(2026, 1, 1)
    ladder = DatedLadder([Step(one, None, "low"), Step(one, D("10"), "mid"), Step(one, D("20.5"), "high"),
                          Step(two, D("0"), "all"), *(Step(two, D(k), f"s{k}") for k in range(5, 500, 5))])
    values = [None, D("-3"), D("0"), D("5"), D("9.99"), D("10"), D("20.49"), D("20.50"), D("77.7"), D("499"), D("100000")]
    rows = [(v, d) for v in values for d in (None, dt.date(2024, 12, 31), one, dt.date(2025, 12, 31), two, dt.date(2030, 1, 1))]
    df = spark.createDataFrame(rows, "v decimal(18,2), d date")

    def want(v, d):
        if d is None or d < one:
            return None
        if d < two:
            return "low" if v is None or v < 10 else "mid" if v < D("20.5") else "high"
        return "all" if v is None or v < 5 else f"s{min(int(v) // 5 * 5, 495)}"
    assert [r.x for r in df.select(ladder.at("v", "d").alias("x")).collect()] == [want(*r) for r in rows]
    got = df.where("v is null").select(ladder.at("v", "d", null_label="none").alias("x"))
    assert [r.x for r in got.collect()] == [None, None, "none", "none", "none", "none"]
    with pytest.raises(ValueError):
        DatedLadder([])
    with pytest.raises(ValueError, match="same bound"):
        DatedLadder([Step(one, None, "a"), Step(one, D("1"), "b"), Step(one, D("1"), "c")])


def test_gaps_and_overlaps_of_intervals_are_refused():
    from decimal import Decimal as D

    from ledgerlens.functions.intervals import check_intervals
    d, e = dt.date(2025, 1, 1), dt.date(2026, 1, 1)
    good = [(d, "B", D("10.00"), D("19.99")), (d, "A", D("0.00"), D("9.99")), (e, "A", D("5.00"), D("6.00"))]
    check_intervals(good)
    for bad, text in (((d, "C", D("19.99"), D("30")), "overlap"), ((d, "C", D("20.01"), D("30")), "gap"),
                      ((d, "C", D("20.00"), D("19")), "ends before")):
        with pytest.raises(ValueError, match=text):
            check_intervals([*good, bad])


def test_the_fixed_values_as_dated_rows_give_the_same_report(spark):
    from ledgerlens.functions import intervals
    fixed = make_day(spark)
    dated = make_day(spark, ladders=intervals.fixed_ladders(dt.date(1900, 1, 1)))

    def rows(df):
        return sorted(map(str, df.collect()))
    assert rows(dated.portfolio) == rows(fixed.portfolio) and rows(dated.scorecard) == rows(fixed.scorecard)
    strict = spark.createDataFrame([(fx.BD, "Critical Exceptions", 0, 0), (dt.date(1900, 1, 1), "Critical Exceptions", 50, 60)],
                                   "effective_from date, metric_name string, green_threshold int, amber_threshold int")
    later_on = make_day(spark, ladders=intervals.Ladders(thresholds=intervals.thresholds_of(strict)))
    status = {r.kpi_name: r.kpi_status for r in later_on.scorecard.collect()}
    assert status["Critical Exceptions"] == "RED" and status == {
        r.kpi_name: "RED" if r.kpi_name == "Critical Exceptions" else r.kpi_status for r in fixed.scorecard.collect()}
