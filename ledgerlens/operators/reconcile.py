"""Dataset reconciliation.

Compares a baseline run with a current run entirely with joins and
aggregates: totals of both sides are grouped under a flag, grouped counts are
full-outer-joined on their keys, hash sets are one full outer join on the hash,
missing/extra rows one aggregate of both sides by the business key.  Nothing is collected into driver-side sets or dicts; the
verdict itself is a DataFrame (``every`` over the checks).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expressions import blank_to_null, lookup_expr, loose_equal
from ..specs import SourceSpec


def _both_sides(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """Rows of both sides under a flag: compared by grouping, without a join."""
    return baseline.withColumn("_base", F.lit(True)).unionByName(current.withColumn("_base", F.lit(False)))


def _base(c: str | Column) -> Column:
    return F.when(F.col("_base"), F.col(c) if isinstance(c, str) else c)


def _cur(c: str | Column) -> Column:
    return F.when(~F.col("_base"), F.col(c) if isinstance(c, str) else c)


def compare_counts(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Row counts per dataset on both sides."""
    def counted(name: str, side: int) -> DataFrame:
        return pairs[name][side].agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("dataset"), "n")

    b, c = (reduce(DataFrame.unionByName, [counted(n, side) for n in pairs]) for side in (0, 1))
    j = _both_sides(b, c).groupBy("dataset").agg(F.max(_base("n")).alias("baseline_count"),
                                                 F.max(_cur("n")).alias("current_count"))
    return j.withColumn("count_match", F.coalesce(F.col("baseline_count") == F.col("current_count"), F.lit(False)))


PORTFOLIO_TOTALS = ("total_balance", "total_accounts", "total_customers")


def _portfolio_totals(df: DataFrame) -> DataFrame:
    return df.agg(
        F.coalesce(F.sum("base_currency_balance"), F.lit(0)).cast("decimal(28,2)").alias("total_balance"),
        F.count("source_account_number").alias("total_accounts"),
        F.countDistinct("customer_id").alias("total_customers"),
        F.count(F.lit(1)).alias("total_rows"))


def _compared_totals(baseline: DataFrame, current: DataFrame, tolerance: Decimal) -> DataFrame:
    names = (*PORTFOLIO_TOTALS, "total_rows")
    j = _both_sides(_portfolio_totals(baseline), _portfolio_totals(current)).agg(
        *(F.max(_base(n)).alias(f"baseline_{n}") for n in names),
        *(F.max(_cur(n)).alias(f"current_{n}") for n in names))
    diff = F.col("baseline_total_balance") - F.col("current_total_balance")
    return j.withColumns({
        "balance_difference": diff.cast("decimal(28,2)"),
        "balance_match": F.abs(diff) < F.lit(tolerance),
        "accounts_match": F.col("baseline_total_accounts") == F.col("current_total_accounts"),
        "customers_match": F.col("baseline_total_customers") == F.col("current_total_customers"),
    })


def compare_aggregates(baseline: DataFrame, current: DataFrame, tolerance: Decimal = Decimal("0.01")) -> DataFrame:
    """Balance (with tolerance), account and customer totals."""
    return _compared_totals(baseline, current, tolerance).drop("baseline_total_rows", "current_total_rows") \
        .withColumn("dataset", F.lit("customer_portfolio"))


def compare_group_counts(baseline: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts per key on both sides (NULL keys compared null-safely), 0 when absent."""
    b = baseline.groupBy(*keys).agg(F.count(F.lit(1)).alias("baseline_count")).alias("b")
    c = current.groupBy(*keys).agg(F.count(F.lit(1)).alias("current_count")).alias("c")
    cond = reduce(lambda x, y: x & y, [F.col(f"b.{k}").eqNullSafe(F.col(f"c.{k}")) for k in keys])
    j = b.join(c, cond, "full_outer")
    bc = F.coalesce(F.col("b.baseline_count"), F.lit(0))
    cc = F.coalesce(F.col("c.current_count"), F.lit(0))
    return j.select(*[F.coalesce(F.col(f"b.{k}"), F.col(f"c.{k}")).alias(k) for k in keys],
                    bc.alias("baseline_count"), cc.alias("current_count"), (bc == cc).alias("count_match"))


DETAIL = ("source_account_number", "customer_id", "rule_code", "severity_code")


def compare_hashes(baseline: DataFrame, current: DataFrame, hash_col: str = "exception_hash",
                   detail: Sequence[str] = DETAIL, beside: str | None = None) -> DataFrame:
    """Every hash with its side (BOTH, BASELINE_ONLY, CURRENT_ONLY) and detail columns.

    ``beside`` names a column of both sides that is equal where the hashes are
    equal: sides that lie by it are not shuffled, and hashes are compared where
    it is equal."""
    near = () if beside is None else (beside,)

    def side(df, p):
        return df.select(F.upper(F.col(hash_col)).alias(hash_col), *detail, *near, F.lit(True).alias("_present")).alias(p)
    cond = F.col(f"b.{hash_col}") == F.col(f"c.{hash_col}")
    for c in near:  # as a number the comparison of the hashes is no further join key
        cond = (F.col(f"b.{c}") == F.col(f"c.{c}")) & (F.when(cond, 1).otherwise(0) == 1)
    j = side(baseline, "b").join(side(current, "c"), cond, "full_outer")
    inb, inc = F.col("b._present").isNotNull(), F.col("c._present").isNotNull()
    status = F.when(inb & inc, F.lit("BOTH")).when(inb, F.lit("BASELINE_ONLY")).otherwise(F.lit("CURRENT_ONLY"))
    return j.select(F.coalesce(F.col(f"b.{hash_col}"), F.col(f"c.{hash_col}")).alias(hash_col),
                    status.alias("hash_status"),
                    *[F.when(inb, F.col(f"b.{d}")).otherwise(F.col(f"c.{d}")).alias(d) for d in detail])


def hash_summary(diff: DataFrame) -> DataFrame:
    return diff.groupBy("hash_status").agg(F.count(F.lit(1)).alias("hash_count"))


def compare_kpis(baseline: DataFrame, current: DataFrame) -> DataFrame:
    """KPI rows by date and name; values equal as numbers within 0.1 (``%``
    stripped) or as case-blind text; statuses case-blind."""
    keys = [k for k in ("business_date", "kpi_name") if k in baseline.columns]
    b = baseline.select(*keys, F.col("kpi_value").alias("baseline_value"),
                        F.col("kpi_status").alias("baseline_status"))
    c = current.select(*keys, F.col("kpi_value").alias("current_value"),
                       F.col("kpi_status").alias("current_status"))
    j = b.join(c, keys, "full_outer")
    return j.withColumns({
        "value_match": F.coalesce(loose_equal("baseline_value", "current_value"), F.lit(False)),
        "status_match": F.coalesce(F.upper(F.col("baseline_status")) == F.upper(F.col("current_status")),
                                   F.lit(False)),
    })


def missing_extra(baseline: DataFrame, current: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys only in the baseline (MISSING) or only in the current run (EXTRA)."""
    # aggregates only: no side is sorted, and distinct keys need no joins that only add columns
    sides = _both_sides(baseline.select(*keys).distinct(), current.select(*keys).distinct()).groupBy(*keys).agg(
        F.bool_or("_base").alias("_b"), F.bool_or(~F.col("_base")).alias("_c"))
    # a key with a null equals no other, so each side lacks the other's
    unlike = reduce(lambda x, y: x | y, (F.col(k).isNull() for k in keys))
    statuses = F.array(F.when(F.col("_b") & (~F.col("_c") | unlike), F.lit("MISSING")),
                       F.when(F.col("_c") & (~F.col("_b") | unlike), F.lit("EXTRA")))
    return (sides.filter(~(F.col("_b") & F.col("_c")) | unlike)
                 .select(*keys, F.explode(statuses).alias("row_status")).filter(F.col("row_status").isNotNull()))


#: Known causes of differences between two runs, by the stage to inspect.
KNOWN_CAUSES = {
    "portfolio load": "runs over different sources, load types or critical-customer exclusions differ by design",
    "currency conversion": "a rate published after the baseline changes balances",
    "inclusion rules": "closed, zero and unrated accounts leave the portfolio",
    "customer enrichment": "a master built from more sources names more customers",
    "rule engine": "exceptions against a smaller master include customers a fuller master knows",
    "exception hashing": "hashes follow the exception rows, so rule differences repeat here",
    "report": "SLA figures depend on the time the report is taken, rates on the exceptions above",
}


def checks(base_portfolio: DataFrame, cur_portfolio: DataFrame, base_exc: DataFrame, cur_exc: DataFrame,
           base_report: DataFrame, cur_report: DataFrame) -> DataFrame:
    """One row per check with both values, pass flag, whether it counts
    for the verdict, the stage to inspect and an explanation when it failed.

    Each frame is aggregated once, to one wide row of both sides; the three
    rows are merged by a further aggregate and expanded by ``inline``.  Row
    counts of the report and the account/customer totals are reported but do
    not decide the verdict."""
    totals = _compared_totals(base_portfolio, cur_portfolio, Decimal("0.01")).drop("balance_difference")

    # exceptions: per hash, then per rule, then over all
    columns = ("exception_hash", "rule_code", "severity_code")
    by_hash = _both_sides(base_exc.select(*columns), cur_exc.select(*columns)).groupBy(
        F.upper("exception_hash").alias("h"), "rule_code", "severity_code").agg(
        F.count_if(F.col("_base")).alias("b"), F.count_if(~F.col("_base")).alias("c"))
    by_rule = by_hash.groupBy("rule_code", "severity_code").agg(
        F.sum("b").alias("b"), F.sum("c").alias("c"), F.count_if(F.col("b") > 0).alias("hb"),
        F.count_if(F.col("c") > 0).alias("hc"), F.every((F.col("b") > 0) & (F.col("c") > 0)).alias("same"))
    zero = F.lit(0).cast("long")
    rules = by_rule.agg(
        F.coalesce(F.sum("b"), zero).alias("exc_b"), F.coalesce(F.sum("c"), zero).alias("exc_c"),
        F.sum("b").alias("rule_b"), F.sum("c").alias("rule_c"), F.every(F.col("b") == F.col("c")).alias("rule_ok"),
        F.coalesce(F.sum("hb"), zero).alias("hash_b"), F.coalesce(F.sum("hc"), zero).alias("hash_c"),
        F.coalesce(F.every("same"), F.lit(True)).alias("hash_ok"))

    report = _both_sides(base_report, cur_report).groupBy("business_date", "kpi_name").agg(
        F.max(_base("kpi_value")).alias("baseline_value"), F.max(_cur("kpi_value")).alias("current_value"),
        F.count_if(F.col("_base")).alias("b"), F.count_if(~F.col("_base")).alias("c"))
    kpis = report.agg(
        F.coalesce(F.sum("b"), zero).alias("report_b"), F.coalesce(F.sum("c"), zero).alias("report_c"),
        F.count("baseline_value").alias("kpi_b"), F.count("current_value").alias("kpi_c"),
        F.coalesce(F.every(F.coalesce(loose_equal("baseline_value", "current_value"), F.lit(False))), F.lit(True))
        .alias("kpi_ok"))

    parts = (totals, rules, kpis)
    names = [c for part in parts for c in part.columns]
    one = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts).agg(
        *(F.max(c).alias(c) for c in names))

    def row(name: str, b: str, c: str, passed: Column, stage: str, in_verdict: bool) -> Column:
        return F.struct(F.lit(name).alias("check_name"), F.col(b).cast("string").alias("baseline_value"),
                        F.col(c).cast("string").alias("current_value"),
                        F.coalesce(passed, F.lit(False)).alias("passed"),
                        F.lit(in_verdict).alias("in_verdict"), F.lit(stage).alias("stage"))

    def equal(b: str, c: str) -> Column:
        return F.col(b) == F.col(c)

    rows = F.array(
        row("portfolio_row_count", "baseline_total_rows", "current_total_rows",
            equal("baseline_total_rows", "current_total_rows"), "portfolio load", True),
        row("exceptions_row_count", "exc_b", "exc_c", equal("exc_b", "exc_c"), "rule engine", True),
        row("report_row_count", "report_b", "report_c", equal("report_b", "report_c"), "report", False),
        row("portfolio_balance", "baseline_total_balance", "current_total_balance", F.col("balance_match"),
            "currency conversion", True),
        row("portfolio_accounts", "baseline_total_accounts", "current_total_accounts", F.col("accounts_match"),
            "inclusion rules", False),
        row("portfolio_customers", "baseline_total_customers", "current_total_customers", F.col("customers_match"),
            "customer enrichment", False),
        row("exceptions_by_rule", "rule_b", "rule_c", F.col("rule_ok"), "rule engine", True),
        row("exception_hashes", "hash_b", "hash_c", F.col("hash_ok"), "exception hashing", True),
        row("kpi_values", "kpi_b", "kpi_c", F.col("kpi_ok"), "report", True))
    out = one.select(F.inline(rows))
    return out.withColumn("explanation", F.when(
        ~F.col("passed"),
        F.concat(F.lit("check "), F.col("check_name"), F.lit(" failed: baseline="),
                 F.coalesce(F.col("baseline_value"), F.lit("NULL")), F.lit(" current="),
                 F.coalesce(F.col("current_value"), F.lit("NULL")), F.lit("; inspect "), F.col("stage"),
                 F.lit("; known causes: "), lookup_expr("stage", tuple(KNOWN_CAUSES.items()), ""))))


def verdict(check_rows: DataFrame) -> DataFrame:
    """PASS when every verdict check passed."""
    v = check_rows.filter(F.col("in_verdict"))
    return v.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~F.col("passed")).alias("failed_checks"),
        F.when(F.coalesce(F.every(F.col("passed")), F.lit(True)), F.lit("PASS")).otherwise(F.lit("FAIL"))
         .alias("verdict"))


def accounts_of_customers(sources: Mapping[str, DataFrame], specs: Sequence[SourceSpec],
                          customer_master: DataFrame) -> DataFrame:
    """Master rows whose customer appears in any source system
    (``IN (... UNION ...)`` as a distinct union + semi join)."""
    ids = reduce(DataFrame.union, [
        sources[s.table].select(blank_to_null(F.col(s.customer).cast("string")).alias("customer_id"))
        for s in specs if s.active]).distinct()
    return customer_master.join(ids, "customer_id", "left_semi")
