"""Portfolio exception rules (Q0-Q12) as a one-pass rule engine.

Instead of one scan plus a cross join to a rule row per rule, every row is
tested against all six rules in a single projection::

    filter(c1 OR ... OR c6) -> explode(array(when(c1, struct(...)), ...)) -> filter(IS NOT NULL)

then the enabled-rule table (config-sized) and the owner table are broadcast
and joined on ``rule_code`` / ``business_area``.  There is no cross join and
no UDF: the SHA-256 over UTF-16-LE content key is a built-in expression.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import specs
from ..functions.expressions import (add_hours, by_hash, content_hash, content_text, fire, lookup_expr,
                                     timestamp_value)
from .portfolio import enrich_customer, salted_key

#: Of exceptions laid by content: 64 bits of the text that ``exception_hash`` is the digest of.
CONTENT = "_content"
#: Of hits found for two frames at once: 1 for all rows, 2 more for the chosen ones.
SCOPES = "_scopes"

STAGING_COLUMNS = (
    "business_date", "source_system_code", "source_account_number", "customer_id", "rule_code",
    "exception_category", "exception_description", "exception_value", "severity_code",
    "business_area", "business_owner", "logged_date",
)

EXCEPTION_COLUMNS = (
    "business_date", "source_system_code", "source_account_number", "customer_id", "rule_code",
    "exception_category", "exception_description", "exception_value", "severity_code",
    "priority_level", "sla_hours", "escalation_required", "escalation_queue", "business_area",
    "business_owner", "exception_hash", "logged_date", "resolution_due_date",
)


def flag_in_master(df: DataFrame, master: DataFrame) -> DataFrame:
    """Add ``in_master`` by a left join to the master's keys (NULL keys salted)."""
    keys = master.select(F.col("customer_id").alias("_m_id")).distinct()
    j = df.withColumn("_ckey", salted_key("customer_id", "source_account_number")).join(
        keys, (F.col("_ckey") == F.col("_m_id")) & F.col("customer_id").isNotNull(), "left")
    return j.withColumn("in_master", F.col("_m_id").isNotNull()).drop("_ckey", "_m_id")


def flag_duplicates(df: DataFrame, chosen: str | None = None) -> DataFrame:
    """``is_duplicate``: the account number occurs more than once on its date.
    With ``chosen``, a boolean column, also ``is_chosen_duplicate``: the same
    among the rows where it is true.

    Each row looks one row back and one ahead among those of its account, so
    ``df`` is read, enriched and shuffled once; a group of equal accounts is
    passed through with a buffer that spills, and joins nothing.  Rows without
    an account or a date are never duplicates; another column spreads them."""
    known = F.col("business_date").isNotNull() & F.col("source_account_number").isNotNull()
    keyed = df.withColumn("_spread", F.when(~known, F.xxhash64(*(c for c in KEYS if c in df.columns))))
    keys = ["business_date", "source_account_number", "_spread"]
    w = Window.partitionBy(*by_hash(keys)).orderBy("_spread" if chosen is None else F.col(chosen).desc())
    near = F.lag(F.lit(True)).over(w).isNotNull() | F.lead(F.lit(True)).over(w).isNotNull()
    flags = {"is_duplicate": near & known}
    if chosen is not None:
        # the chosen rows of an account come first
        beside = F.lag(chosen, 1, False).over(w) | F.lead(chosen, 1, False).over(w)
        flags["is_chosen_duplicate"] = F.col(chosen) & beside & known
    # shuffled by the hash as an expression, so that it is not written beside the keys
    return keyed.repartition(F.xxhash64(*keys)).withColumns(flags).drop("_spread")


def narrowed(accounts: DataFrame, *more: str) -> DataFrame:
    """What the rules read of the accounts, and ``more`` columns.  A value that no
    rule of its row reports is left out: what most rows have is nothing to shuffle."""
    known, missing = F.col("product_description").isNotNull(), F.col("rate_missing")
    balance, closed = F.col("base_currency_balance"), F.col("account_status") == "CLOSED"
    return accounts.select(*KEYS, *more, "rate_missing", F.when(known, F.lit("")).alias("product_description"),
                           F.when(~known, F.col("product_code")).alias("product_code"),
                           F.when(missing, F.col("currency_code")).alias("currency_code"),
                           F.when(balance < 0, balance).alias("base_currency_balance"),
                           F.when(closed, F.col("account_status")).alias("account_status"))


def flag_accounts(accounts: DataFrame, master: DataFrame, chosen: str | None = None) -> DataFrame:
    """Accounts as the rules read them (see ``narrowed``): with ``in_master``, the
    master's columns and the flags of ``flag_duplicates``.

    The duplicates are found before the customers are joined: neither shuffle
    of the accounts depends on the master, so runs that differ in it share both.
    A customer that the master holds twice makes two rows of each account, which
    then are duplicates as well."""
    known = F.col("business_date").isNotNull() & F.col("source_account_number").isNotNull()
    rows = narrowed(accounts, *(() if chosen is None else (chosen,)))
    df = enrich_customer(flag_duplicates(rows, chosen), master, repeated="_repeated")
    flags = {"is_duplicate": F.col("is_duplicate") | (known & F.col("_repeated"))}
    if chosen is not None:
        flags["is_chosen_duplicate"] = F.col("is_chosen_duplicate") | (known & F.col("_repeated") & F.col(chosen))
    return df.withColumns(flags).drop("_repeated").withColumn("eligible_for_reporting", F.lit("Y"))


def _hit(cond: Column, code: str, value: Column, *more: Column) -> tuple[Column, Column]:
    return cond, F.struct(
        F.lit(code).alias("rule_code"),
        F.lit(specs.RULE_DESCRIPTIONS[code]).alias("exception_description"),
        value.cast("string").alias("exception_value"),
        *more,
    )


KEYS = ("business_date", "source_system_code", "source_account_number", "customer_id")


def rule_hits(frame: DataFrame, master: DataFrame | None = None,
              base_currency: str = specs.BASE_CURRENCY,
              codes: Sequence[str] | None = None, carry: Sequence[str] = (),
              chosen: str | None = None) -> DataFrame:
    """Q1-Q6 in one pass: one row per (account row, fired rule).

    Works on the final portfolio or on unfiltered staged rows (D12): DQ003
    uses ``rate_missing`` when the frame has it, else ``exchange_rate IS NULL``.
    Only the rules in ``codes`` (default: all) are evaluated, with only the
    flags they need; ``carry`` names frame columns to keep on each hit.  With
    ``chosen``, a boolean column of rows from ``flag_accounts``, every hit tells
    in ``SCOPES`` whether the rules find it among the chosen rows alone, too.
    """
    wanted = [r.code for r in specs.RULES] if codes is None else list(codes)
    df = frame
    if "DQ001" in wanted and "in_master" not in df.columns:
        if master is None:
            raise ValueError("frame has no in_master flag; pass the customer master")
        df = flag_in_master(df, master)
    if "DQ006" in wanted and "is_duplicate" not in df.columns:
        df = flag_duplicates(df)
    if "rate_missing" in df.columns:
        rate_missing = F.col("rate_missing")
    else:
        rate_missing = F.col("exchange_rate").isNull() & (F.col("currency_code") != F.lit(base_currency))
    tests = {
        "DQ001": lambda: (~F.col("in_master") & F.col("customer_id").isNotNull(), F.col("customer_id")),
        "DQ002": lambda: (F.col("product_description").isNull(), F.col("product_code")),
        "DQ003": lambda: (rate_missing, F.col("currency_code")),
        "DQ004": lambda: (F.col("base_currency_balance") < 0, F.col("base_currency_balance")),
        "DQ005": lambda: ((F.col("account_status") == "CLOSED") & (F.col("eligible_for_reporting") == "Y"),
                          F.col("account_status")),
        "DQ006": lambda: (F.col("is_duplicate"), F.col("source_account_number")),
    }
    hits = []
    for code in wanted:
        cond, value = tests[code]()
        found = []
        if chosen is not None:
            among = F.col("is_chosen_duplicate" if code == "DQ006" else chosen)
            found.append(F.when(among, F.lit(3)).otherwise(F.lit(1)).cast("tinyint").alias(SCOPES))
        hits.append(_hit(cond, code, value, *found))
    keep = (*KEYS, *carry)
    return fire(df, keep, hits, "h").select(*keep, "h.rule_code", "h.exception_description",
                                            "h.exception_value", *(() if chosen is None else (f"h.{SCOPES}",)))


def laid_by_content(hits: DataFrame) -> DataFrame:
    """The hits shuffled by the text of their ``exception_hash``, of which ``CONTENT``
    is 64 bits, and without their descriptions.  Rows to compare in Q7 and rows with
    equal hashes then lie together, so that neither Q7 nor a join by the hash
    shuffles them again, and the hash is never written.  Hits that Q7 finds alike
    meet whole in one task; Q7 by itself would leave one a task before its shuffle."""
    key = F.xxhash64(content_text(F.col("business_date").cast("string"), "customer_id", "rule_code", "exception_value"))
    # by an expression, which is not written beside its parts
    return hits.drop("exception_description").repartition(key).withColumn(CONTENT, key)


def attach_rule_config(hits: DataFrame, rules: DataFrame, owners: DataFrame, as_of,
                       carry: Sequence[str] = ()) -> DataFrame:
    """Q0: keep enabled rules (inner, broadcast) and resolve the owner (left, broadcast)."""
    r = rules.filter(F.col("rule_enabled")).select(
        F.col("rule_code").alias("_r_code"), "exception_category", "severity_code", "business_area")
    o = owners.select(F.col("business_area").alias("_o_area"), "business_owner")
    return (hits.join(F.broadcast(r), F.col("rule_code") == F.col("_r_code"), "inner")
                .join(F.broadcast(o), F.col("business_area") == F.col("_o_area"), "left")
                .withColumn("logged_date", timestamp_value(as_of))
                .select(*STAGING_COLUMNS, *carry))


def dedupe_exceptions(exceptions: DataFrame, within: Column | None = None) -> DataFrame:
    """Q7: newest row per (date, customer, rule, value); ties broken by source
    and account so the survivor is deterministic (D14).  DQ001 therefore
    collapses to one row per customer.  ``row_number() = 1`` plans a partial
    WindowGroupLimit below the shuffle, so large groups shrink map-side.  Rows
    laid by content are not shuffled.  Only rows ``within`` count."""
    keys = ("business_date", "customer_id", "rule_code", "exception_value")
    first = F.col("_rn") == 1
    w = Window.partitionBy(*((CONTENT, *keys) if CONTENT in exceptions.columns else by_hash(keys))).orderBy(
        *(() if within is None else (within.desc(),)),
        F.col("logged_date").desc(), F.col("source_system_code").asc_nulls_last(),
        F.col("source_account_number").asc_nulls_last())
    return exceptions.withColumn("_rn", F.row_number().over(w)) \
        .filter(first if within is None else first & within).drop("_rn")


def enrich_exceptions(exceptions: DataFrame, severities: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Q8-Q10: SLA from the severity table, due date, content hash, queue."""
    s = severities.select(F.col("severity_code").alias("_s_code"), "priority_level", "sla_hours",
                          "escalation_required")
    j = exceptions.join(F.broadcast(s), F.col("severity_code") == F.col("_s_code"), "left").drop("_s_code")
    return j.withColumns({
        "resolution_due_date": add_hours("logged_date", "sla_hours"),
        "exception_hash": content_hash(F.col("business_date").cast("string"), "customer_id",
                                       "rule_code", "exception_value"),
        "escalation_queue": lookup_expr("severity_code", specs.ESCALATION_QUEUES,
                                        specs.ESCALATION_QUEUE_OTHERWISE),
    }).select(*EXCEPTION_COLUMNS, *carry)


def run_rules(frame: DataFrame, rules: DataFrame, owners: DataFrame, severities: DataFrame,
              as_of, master: DataFrame | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Q0-Q10 end to end: hits -> config -> dedupe -> SLA/hash/queue."""
    staged = attach_rule_config(rule_hits(frame, master, carry=carry), rules, owners, as_of, carry)
    return enrich_exceptions(dedupe_exceptions(staged), severities, carry)


def run_rules_by_content(frame: DataFrame, rules: DataFrame, owners: DataFrame, severities: DataFrame,
                         as_of, chosen: str | None = None) -> tuple[DataFrame, ...]:
    """``run_rules`` for joins by ``exception_hash``: the exceptions with ``CONTENT``,
    by which they lie.  With ``chosen`` two frames, the exceptions of all rows and
    those of the chosen rows alone, from one pass over ``frame`` and one shuffle
    of its hits.  What follows from the rule joins the rows after Q7, which sorts
    them without it; a rule or area configured twice still makes one exception."""
    hits = laid_by_content(rule_hits(frame, chosen=chosen)).withColumn("logged_date", timestamp_value(as_of))
    r = rules.filter(F.col("rule_enabled")).dropDuplicates(["rule_code"])
    o = owners.dropDuplicates(["business_area"])
    described = lookup_expr("rule_code", specs.RULE_DESCRIPTIONS.items(), None)

    def part(within: Column | None) -> DataFrame:
        kept = dedupe_exceptions(hits, within).withColumn("exception_description", described)
        return enrich_exceptions(attach_rule_config(kept, r, o, as_of, (CONTENT,)), severities, (CONTENT,))

    if chosen is None:
        return (part(None),)
    # a test that both frames make after the shuffle, so that it is one shuffle for both
    return tuple(part(F.col(SCOPES).bitwiseAND(F.lit(bit)) != 0) for bit in (1, 2))


def exception_counts(staged: DataFrame) -> DataFrame:
    """Q7 metric (A17): rows found, rows kept and duplicates removed.

    Partial aggregation per dedupe key first, so the global total only sees
    one row per group."""
    groups = staged.groupBy("business_date", "customer_id", "rule_code", "exception_value").agg(
        F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("exceptions_found"),
        F.count(F.lit(1)).alias("exceptions_kept"),
        (F.coalesce(F.sum("_n"), F.lit(0)) - F.count(F.lit(1))).cast("long").alias("duplicates_removed"),
    )


def area_summary(exceptions: DataFrame) -> DataFrame:
    """Q11: per business area and owner."""
    sev = F.col("severity_code")
    return exceptions.groupBy("business_date", "business_area", "business_owner").agg(
        F.count(F.lit(1)).alias("total_exceptions"),
        F.count_if(sev == "CRITICAL").alias("critical_exceptions"),
        F.count_if(sev == "HIGH").alias("high_exceptions"),
        F.count_if(sev == "MEDIUM").alias("medium_exceptions"),
        F.count_if(sev == "LOW").alias("low_exceptions"),
        F.count_if(F.col("escalation_required")).alias("escalated_exceptions"),
    )


def severity_area_dashboard(exceptions: DataFrame) -> DataFrame:
    """Severity x area counts, customers and accounts affected."""
    return exceptions.groupBy("business_date", "severity_code", "business_area").agg(
        F.count(F.lit(1)).alias("exception_count"),
        F.countDistinct("customer_id").alias("customers_affected"),
        F.countDistinct("source_system_code", "source_account_number").alias("accounts_affected"),
    )


def owner_next_due(exceptions: DataFrame) -> DataFrame:
    """Q12: each owner's open count and the next resolution due date."""
    return exceptions.groupBy("business_owner").agg(
        F.count(F.lit(1)).alias("open_exceptions"),
        F.min("resolution_due_date").alias("next_due_date"),
    )
