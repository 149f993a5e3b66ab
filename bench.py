"""Benchmark: headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is forced with a ``noop`` sink (full computation, nothing
collected); the value is the median of $BENCH_RUNS warm runs (default 3).
``daily_run`` is the whole nightly run: guards, stored shared frames, all
tables loaded under the run log.  ``build_sec`` is the part of a query's time
that building it takes, the stored priced accounts included.  ``rules_six_scans`` is the reference's
plan shape (one filtered scan per rule, unioned) kept for comparison with
the one-pass ``rules_one_pass``.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ledgerlens import specs  # noqa: E402
from ledgerlens.operators import rules  # noqa: E402
from ledgerlens.plans.bank_day import BankDay  # noqa: E402
from ledgerlens.plans.catalog import QUERIES  # noqa: E402
from ledgerlens.plans.daily import run_daily  # noqa: E402
from ledgerlens.session import build_session  # noqa: E402

HEADLINE = ["portfolio", "exceptions", "exceptions_staged_rows", "scorecard", "upsert_master",
            "source_quality", "branch_quality", "recon_hash_diff"]
#: Timed once each after a warm-up of the headline queries.
FURTHER = ["recon_checks", "recon_verdict", "runlog_latest", "upsert_exceptions", "upsert_portfolio",
           "recon_missing_extra", "executive_dashboard", "portfolio_errors"]


def force(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, runs: int) -> float:
    fn()  # warm-up
    times = []
    for _ in range(runs):
        t = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t)
    return statistics.median(times)


def six_scan_rules(frame: DataFrame, as_of) -> DataFrame:
    """Reference plan shape: one scan + filter per rule, then a union."""
    desc = specs.RULE_DESCRIPTIONS
    dup = frame.groupBy("business_date", "source_account_number").count().filter("count > 1") \
        .select("business_date", "source_account_number")
    parts = [
        frame.filter(~F.col("in_master") & F.col("customer_id").isNotNull())
             .select(*rules.STAGING_COLUMNS[:4], F.lit("DQ001").alias("rule_code"),
                     F.lit(desc["DQ001"]).alias("exception_description"), F.col("customer_id").alias("exception_value")),
        frame.filter(F.col("product_description").isNull())
             .select(*rules.STAGING_COLUMNS[:4], F.lit("DQ002").alias("rule_code"),
                     F.lit(desc["DQ002"]).alias("exception_description"), F.col("product_code").alias("exception_value")),
        frame.filter(F.col("rate_missing"))
             .select(*rules.STAGING_COLUMNS[:4], F.lit("DQ003").alias("rule_code"),
                     F.lit(desc["DQ003"]).alias("exception_description"), F.col("currency_code").alias("exception_value")),
        frame.filter(F.col("base_currency_balance") < 0)
             .select(*rules.STAGING_COLUMNS[:4], F.lit("DQ004").alias("rule_code"),
                     F.lit(desc["DQ004"]).alias("exception_description"),
                     F.col("base_currency_balance").cast("string").alias("exception_value")),
        frame.filter((F.col("account_status") == "CLOSED") & (F.col("eligible_for_reporting") == "Y"))
             .select(*rules.STAGING_COLUMNS[:4], F.lit("DQ005").alias("rule_code"),
                     F.lit(desc["DQ005"]).alias("exception_description"), F.col("account_status").alias("exception_value")),
        frame.join(dup, ["business_date", "source_account_number"])
             .select(*rules.STAGING_COLUMNS[:4], F.lit("DQ006").alias("rule_code"),
                     F.lit(desc["DQ006"]).alias("exception_description"),
                     F.col("source_account_number").alias("exception_value")),
    ]
    return reduce(DataFrame.unionByName, parts)


def timed_query(name: str, spark, sf_dir: str) -> tuple[float, float]:
    """Seconds to build the query (its shared checkpoint included) and to run it."""
    t = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    built = time.perf_counter()
    force(df)
    return built - t, time.perf_counter() - built


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    scratch = tempfile.mkdtemp(prefix="ledgerlens-bench-", dir="/tmp")
    spark = build_session(f"local[{cpus}]", app="ledgerlens-bench", shuffle_partitions=max(8, 2 * cpus),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                                 "spark.checkpoint.dir": f"{scratch}/checkpoints"})

    results: dict[str, float] = {}
    build: dict[str, float] = {}
    for name in HEADLINE:
        timed_query(name, spark, sf_dir)
        both = [timed_query(name, spark, sf_dir) for _ in range(runs)]
        results[name] = round(statistics.median(sum(x) for x in both), 3)
        build[name] = round(statistics.median(x[0] for x in both), 3)
    for name in FURTHER:
        both = timed_query(name, spark, sf_dir)
        results[name], build[name] = round(sum(both), 3), round(both[0], 3)

    counter = iter(range(10_000))
    results["daily_run"] = round(timed(lambda: run_daily(
        BankDay.from_testdata(spark, sf_dir, execution_id="BENCH"), f"{scratch}/out{next(counter)}"), 1), 3)

    # rule engine alone, on one checkpointed enriched frame
    d = BankDay.from_testdata(spark, sf_dir).materialize(("customer_master", "enriched"))
    enriched = d.enriched
    results["rules_one_pass"] = round(timed(lambda: force(rules.rule_hits(enriched)), runs), 3)
    results["rules_six_scans"] = round(timed(lambda: force(six_scan_rules(enriched, d.as_of)), runs), 3)

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    headline_total = round(sum(results[n] for n in HEADLINE), 3)
    print(json.dumps({
        "metric": "headline_queries_total_sec",
        "value": headline_total,
        "unit": "sec",
        "queries": results,
        "build_sec": build,
        "sf": float(sf.group(1)) if sf else sf_dir,
        "cpus": cpus,
        "runs": runs,
        "rows": {"staged_accounts": d.staged.count()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()
