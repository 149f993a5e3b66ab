"""Independent DuckDB SQL for every registered query (the correctness oracle).

The same business day is written a second time, as plain SQL over the
driver's test tables: account-system views, customer master + upsert,
cleansing, enrichment, inclusion, metrics, rules, KPIs and reconciliation.
Configuration rows are inlined as ``VALUES`` generated from ``ledgerlens.specs``
so both engines share one copy of the fixed values: a wrong fixed value shows
in the golden tests, not here.

Numeric care: percentages are computed with integer half-up arithmetic
(DuckDB divides decimals in double precision), the UTF-16-LE content hash is
built from the hex of the (ASCII) text with a zero byte after each byte.
"""

from __future__ import annotations

import datetime as dt

from ledgerlens import specs
from ledgerlens.operators.reconcile import KNOWN_CAUSES
from ledgerlens.sources import testdata as td

BD = td.BUSINESS_DATE.isoformat()
AS_OF = td.AS_OF.strftime("%Y-%m-%d %H:%M:%S")
REPORT_AS_OF = td.REPORT_AS_OF.strftime("%Y-%m-%d %H:%M:%S")
SEED_CREATED = td.SEED_CREATED.strftime("%Y-%m-%d %H:%M:%S")
TREND_DATE = td.TREND_DATE.isoformat()
TREND_FROM = (td.TREND_DATE - dt.timedelta(days=45)).isoformat()


def q(s) -> str:
    if s is None:
        return "NULL"
    if isinstance(s, bool):
        return "TRUE" if s else "FALSE"
    if isinstance(s, int):
        return str(s)
    return "'" + str(s).replace("'", "''") + "'"


def pct(n: str, d: str) -> str:
    """round(n * 100 / d, 2) half-up as DECIMAL(10,2); NULL when d = 0 (n, d >= 0 integers)."""
    return (f"CAST(CAST((CAST({n} AS HUGEINT) * 20000 + CAST({d} AS HUGEINT)) // (2 * NULLIF(CAST({d} AS HUGEINT), 0)) "
            f"AS DECIMAL(20,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2))")


def utf16_hash(expr: str) -> str:
    return f"upper(sha256(unhex(regexp_replace(hex({expr}), '(..)', '\\100', 'g'))))"


# ---------------------------------------------------------------------------
# configuration CTEs
# ---------------------------------------------------------------------------

def config_ctes() -> list[str]:
    prod = ", ".join(f"({q(a)}, {q(b)}, {q(c)}, {q(d)}, {q(e)}, DATE '{specs.PRODUCT_EFFECTIVE_DATE}')"
                     for a, b, c, d, e in specs.PRODUCTS)
    fx = ", ".join(f"({q(c)}, CAST({r} AS DECIMAL(18,8)), DATE '{specs.FX_EFFECTIVE_DATE}')" for c, r in specs.FX_RATES)
    rules = ", ".join(f"({q(r.code)}, {q(r.category)}, {q(r.severity)}, {q(r.area)}, {q(r.enabled)}, "
                      f"{q(specs.RULE_DESCRIPTIONS[r.code])})" for r in specs.RULES)
    cats = ", ".join(f"({q(a)}, {q(b)}, {q(c)}, {q(d)})" for a, b, c, d in specs.EXCEPTION_CATEGORIES)
    sev = ", ".join(f"({q(a)}, CAST({b} AS INTEGER), CAST({c} AS INTEGER), {q(d)})" for a, b, c, d in specs.SEVERITIES)
    own = ", ".join(f"({q(a)}, {q(b)}, {q(c)})" for a, b, c in specs.OWNERS)
    return [
        f"cfg_products(product_code, product_description, product_category, regulatory_category, product_status, effective_date) AS (VALUES {prod})",
        f"cfg_fx(currency_code, exchange_rate, effective_date) AS (VALUES {fx})",
        f"cfg_rules(rule_code, exception_category, severity_code, business_area, rule_enabled, rule_text) AS (VALUES {rules})",
        f"cfg_categories(exception_category, description, default_severity, business_area) AS (VALUES {cats})",
        f"cfg_severity(severity_code, priority_level, sla_hours, escalation_required) AS (VALUES {sev})",
        f"cfg_owners(business_area, business_owner, support_team) AS (VALUES {own})",
    ]


# ---------------------------------------------------------------------------
# account systems derived from the test tables (mirror of sources/testdata.py)
# ---------------------------------------------------------------------------

def source_ctes() -> list[str]:
    d = f"DATE '{BD}'"
    return [
        f"""src_core AS (SELECT 'CB' || CAST(c_custkey AS VARCHAR) AS account_number,
              CASE WHEN c_custkey % 97 = 0 THEN '   ' ELSE ' CUST' || CAST(c_custkey AS VARCHAR) END AS customer_number,
              CASE WHEN c_custkey % 50 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN ' sav001 '
                   WHEN c_custkey % 3 = 1 THEN 'CUR001' ELSE 'cur001' END AS product_code,
              CAST(c_acctbal AS DECIMAL(18,2)) AS account_balance,
              CASE c_nationkey % 6 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'eur' WHEN 3 THEN 'GBP'
                   WHEN 4 THEN 'ZAR' ELSE 'XXX' END AS currency,
              CASE WHEN c_custkey % 20 = 0 THEN 'CLOSED' WHEN c_custkey % 45 = 0 THEN 'closed'
                   WHEN c_custkey % 7 = 0 THEN 'active' ELSE 'ACTIVE' END AS account_status,
              {d} AS record_date FROM customer)""",
        f"""src_loans AS (SELECT 'LN' || CAST(o_orderkey AS VARCHAR) AS loan_number,
              'CUST' || CAST(o_custkey AS VARCHAR) AS client_id,
              CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'HOME_LOAN' ELSE 'PERSONAL_LOAN' END AS loan_product,
              CAST(o_totalprice AS DECIMAL(18,2)) AS outstanding_amount,
              CASE o_orderkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'ZAR' ELSE 'JPY' END AS loan_currency,
              CASE WHEN o_orderstatus = 'F' THEN 'CLOSED' ELSE 'ACTIVE' END AS loan_status,
              {d} AS snapshot_date FROM orders)""",
        f"""src_cards AS (SELECT 'CARD' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS card_account_number,
              'CUST' || CAST(o_custkey AS VARCHAR) AS client_number,
              CASE WHEN l_returnflag = 'R' THEN 'GOLD_CARD' ELSE 'STANDARD_CARD' END AS card_product,
              CASE WHEN l_quantity >= 50 THEN NULL WHEN l_returnflag = 'R' THEN -CAST(l_extendedprice AS DECIMAL(18,2))
                   ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS credit_balance,
              CASE l_suppkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'GBP' END AS card_currency,
              CASE WHEN l_linestatus = 'O' THEN 'ACTIVE' ELSE 'active' END AS card_status,
              {d} AS business_date FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
        f"""src_inv AS (SELECT 'INV' || CAST(p_partkey AS VARCHAR) AS investment_id,
              'CUST' || CAST(p_partkey * 7 AS VARCHAR) AS investor_id,
              CASE WHEN p_size % 2 = 0 THEN 'EQUITY_FUND' ELSE 'BOND_FUND' END AS investment_product,
              CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 1000 AS DECIMAL(18,2)) AS market_value,
              CASE WHEN p_partkey % 2 = 0 THEN 'USD' ELSE 'EUR' END AS investment_currency,
              'ACTIVE' AS investment_status, {d} AS valuation_date FROM part)""",
        f"""src_mort AS (SELECT 'MORT' || CAST(o_orderkey AS VARCHAR) AS mortgage_number,
              'CUST' || CAST(o_custkey AS VARCHAR) AS client_code, 'HOME' AS mortgage_type,
              CAST(o_totalprice AS DECIMAL(18,2)) AS balance_amount, 'USD' AS currency_code,
              CASE WHEN o_orderstatus = 'F' THEN 'CLOSED' ELSE 'ACTIVE' END AS status,
              {d} AS effective_date FROM orders WHERE o_totalprice > 400000)""",
        f"""src_mobile AS (SELECT 'WAL' || CAST(event_id AS VARCHAR) AS wallet_id,
              'CUST' || CAST(user_id AS VARCHAR) AS customer_number, 'MOBILE_WALLET' AS wallet_product,
              CASE WHEN event_type = 'error' THEN -CAST(value AS DECIMAL(18,2)) ELSE CAST(value AS DECIMAL(18,2)) END AS wallet_balance,
              CASE WHEN event_type = 'purchase' THEN 'ZAR' ELSE 'USD' END AS wallet_currency,
              'ACTIVE' AS wallet_status, CAST(ts AS DATE) + {td.MOBILE_DAY_SHIFT} AS load_date FROM events)""",
        f"""src_forex AS (SELECT 'FX' || CAST(s_suppkey AS VARCHAR) AS trade_id,
              'CUST' || CAST(s_suppkey + 1000000 AS VARCHAR) AS customer_id,
              CASE WHEN s_nationkey % 2 = 0 THEN 'FX_FORWARD' ELSE 'FX_SWAP' END AS forex_product,
              CAST(-CAST(s_acctbal AS DECIMAL(18,2)) * 10 AS DECIMAL(18,2)) AS trade_amount,
              'GBP' AS trade_currency, 'ACTIVE' AS trade_status, {d} AS trade_date FROM supplier)""",
        f"""seed_master AS (SELECT 'CUST' || CAST(c_custkey AS VARCHAR) AS customer_id,
              lower(c_mktsegment) AS first_name, c_name AS last_name,
              CASE WHEN c_mktsegment = 'BUILDING' THEN 'PREMIUM' WHEN c_mktsegment = 'AUTOMOBILE' THEN 'BUSINESS'
                   ELSE 'STANDARD' END AS customer_category,
              'BR' || lpad(CAST(c_nationkey % 9 + 1 AS VARCHAR), 3, '0') AS branch_code,
              'ACTIVE' AS customer_status, TIMESTAMP '{SEED_CREATED}' AS created_date,
              CAST(NULL AS TIMESTAMP) AS last_updated_date, CAST(NULL AS VARCHAR) AS primary_source_system_code
              FROM customer)""",
    ]


# (source code, cte, priority, account, customer, product, balance, currency, status, date)
SOURCE_MAP = [
    ("CORE_BANKING", "src_core", 1, "account_number", "customer_number", "product_code", "account_balance", "currency", "account_status", "record_date"),
    ("LOANS", "src_loans", 2, "loan_number", "client_id", "loan_product", "outstanding_amount", "loan_currency", "loan_status", "snapshot_date"),
    ("CARDS", "src_cards", 3, "card_account_number", "client_number", "card_product", "credit_balance", "card_currency", "card_status", "business_date"),
    ("INVESTMENTS", "src_inv", 4, "investment_id", "investor_id", "investment_product", "market_value", "investment_currency", "investment_status", "valuation_date"),
    ("MORTGAGE", "src_mort", 5, "mortgage_number", "client_code", "mortgage_type", "balance_amount", "currency_code", "status", "effective_date"),
    ("MOBILE", "src_mobile", 6, "wallet_id", "customer_number", "wallet_product", "wallet_balance", "wallet_currency", "wallet_status", "load_date"),
    ("FOREX", "src_forex", 7, "trade_id", "customer_id", "forex_product", "trade_amount", "trade_currency", "trade_status", "trade_date"),
]


def blank_null(e: str) -> str:
    return f"CASE WHEN trim({e}) <> '' THEN trim({e}) END"


def master_ctes(include=specs.FIRST_PASS_SOURCES, prefix="") -> list[str]:
    ids = " UNION ALL ".join(
        f"SELECT CAST({cust} AS VARCHAR) AS customer_id, '{code}' AS source_system_code, {prio} AS source_priority FROM {cte}"
        for code, cte, prio, acct, cust, *_ in SOURCE_MAP if code in include)
    p = prefix
    return [
        f"{p}ids AS ({ids})",
        f"{p}ids_clean AS (SELECT {blank_null('customer_id')} AS customer_id, source_system_code, source_priority FROM {p}ids)",
        f"""{p}new_master AS (SELECT customer_id, 'Customer' AS first_name, customer_id AS last_name,
              'STANDARD' AS customer_category, 'BR001' AS branch_code, 'ACTIVE' AS customer_status,
              TIMESTAMP '{AS_OF}' AS created_date, TIMESTAMP '{AS_OF}' AS last_updated_date,
              source_system_code AS primary_source_system_code
            FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY source_priority, source_system_code) AS rn
                  FROM {p}ids_clean WHERE customer_id IS NOT NULL) WHERE rn = 1)""",
    ]


def upsert_sql(name: str, target: str, source: str, keys: list[str], cols: list[str],
               change: dict[str, str], update: list[str], delete_unmatched: bool, source_cols=None,
               null_safe_keys: bool = False) -> str:
    """Keyed conditional upsert as one full outer join (mirror of operators/upsert.py)."""
    source_cols = cols if source_cols is None else source_cols
    eq = "IS NOT DISTINCT FROM" if null_safe_keys else "="
    on = " AND ".join(f"t.{k} {eq} s.{k}" for k in keys)
    diff = " OR ".join(f"coalesce(t.{c}, {d}) <> coalesce(s.{c}, {d})" for c, d in change.items()) or "FALSE"
    action = (f"(CASE WHEN s._sp AND t._tp IS NULL THEN 'INSERT' WHEN s._sp AND t._tp AND ({diff}) THEN 'UPDATE' "
              f"WHEN s._sp AND t._tp THEN 'NOOP' ELSE '{'DELETE' if delete_unmatched else 'KEEP'}' END)")

    def out(c):
        if c in keys:
            return f"CASE WHEN t._tp THEN t.{c} ELSE s.{c} END AS {c}"
        sc = f"s.{c}" if c in source_cols else "NULL"
        if c in update:
            return f"CASE WHEN {action} IN ('INSERT', 'UPDATE') THEN {sc} ELSE t.{c} END AS {c}"
        return f"CASE WHEN {action} = 'INSERT' THEN {sc} ELSE t.{c} END AS {c}"

    return (f"{name} AS (SELECT {', '.join(out(c) for c in cols)}, {action} AS _action "
            f"FROM (SELECT *, TRUE AS _tp FROM {target}) t FULL OUTER JOIN (SELECT *, TRUE AS _sp FROM {source}) s ON {on})")


MASTER_COLS = ["customer_id", "first_name", "last_name", "customer_category", "branch_code",
               "customer_status", "created_date", "last_updated_date", "primary_source_system_code"]


def upsert_master_ctes(p: str = "") -> list[str]:
    upd = ["first_name", "last_name", "customer_category", "branch_code", "customer_status",
           "last_updated_date", "primary_source_system_code"]
    return [
        upsert_sql(f"{p}master_upsert", "seed_master", f"{p}new_master", ["customer_id"], MASTER_COLS,
                   {"customer_status": "''", "customer_category": "''"}, upd, True),
        f"{p}customer_master AS (SELECT * EXCLUDE (_action) FROM {p}master_upsert WHERE _action <> 'DELETE')",
    ]


def staged_cte(date_pred: str, load_type: str = "FULL", name: str = "staged") -> str:
    parts = []
    for code, cte, prio, acct, cust, prod, bal, ccy, st, dcol in SOURCE_MAP:
        where = [date_pred.format(col=dcol)]
        if load_type == "INCREMENTAL":
            where.append(f"{st} <> 'CLOSED'")
        parts.append(
            f"SELECT '{code}' AS source_system_code, CAST({acct} AS VARCHAR) AS source_account_number, "
            f"CAST({cust} AS VARCHAR) AS customer_id, CAST({prod} AS VARCHAR) AS product_code, "
            f"CAST({ccy} AS VARCHAR) AS currency_code, CAST({bal} AS DECIMAL(18,2)) AS account_balance, "
            f"CAST({st} AS VARCHAR) AS account_status, CAST({dcol} AS DATE) AS business_date "
            f"FROM {cte} WHERE {' AND '.join(where)}")
    return f"{name} AS ({' UNION ALL '.join(parts)})"


def pipeline_ctes(p: str = "", date_pred: str = f"{{col}} = DATE '{BD}'", load_type: str = "FULL",
                  master: str = "customer_master", critical: str = "critical_customers") -> list[str]:
    """Staged -> clean -> enriched -> portfolio rows -> exceptions, names prefixed by ``p``."""
    bands = sorted(specs.VALUE_BANDS, key=lambda b: b.minimum, reverse=True)
    band_sql = "CASE " + " ".join(f"WHEN base_currency_balance >= {b.minimum} THEN '{b.name}'" for b in bands[:-1]) \
        + f" ELSE '{bands[-1].name}' END"
    esc = "CASE " + " ".join(f"WHEN d.severity_code = '{s}' THEN '{v}'" for s, v in specs.ESCALATION_QUEUES) \
        + f" ELSE '{specs.ESCALATION_QUEUE_OTHERWISE}' END"
    hash_expr = utf16_hash("coalesce(CAST(d.business_date AS VARCHAR), '') || coalesce(d.customer_id, '') || "
                           "coalesce(d.rule_code, '') || coalesce(d.exception_value, '')")
    return [
        staged_cte(date_pred, load_type, f"{p}staged"),
        f"""{p}clean AS (SELECT source_system_code, source_account_number, {blank_null('customer_id')} AS customer_id,
              upper({blank_null('product_code')}) AS product_code, upper({blank_null('currency_code')}) AS currency_code,
              account_balance, upper(account_status) AS account_status, business_date FROM {p}staged)""",
        f"""{p}conv AS (SELECT c.*, f.exchange_rate IS NOT NULL AS rate_found,
              coalesce(f.exchange_rate, CAST(1 AS DECIMAL(18,8))) AS exchange_rate,
              CAST(round(c.account_balance * coalesce(f.exchange_rate, CAST(1 AS DECIMAL(18,8))), 2) AS DECIMAL(18,2)) AS base_currency_balance,
              (f.exchange_rate IS NULL AND c.currency_code IS NOT NULL AND c.currency_code <> 'USD') AS rate_missing
            FROM {p}clean c LEFT JOIN cfg_fx f ON c.currency_code = upper(f.currency_code) AND c.business_date = f.effective_date)""",
        f"""{p}enriched AS (SELECT c.*, pr.product_description, pr.product_category, pr.regulatory_category,
              m.first_name || ' ' || m.last_name AS customer_name, m.customer_category, m.branch_code,
              m.customer_id IS NOT NULL AS in_master, 'Y' AS eligible_for_reporting
            FROM {p}conv c
            LEFT JOIN (SELECT * FROM cfg_products WHERE product_status = 'ACTIVE') pr ON c.product_code = pr.product_code
            LEFT JOIN {master} m ON c.customer_id = m.customer_id)""",
        f"""{p}included AS (SELECT * FROM {p}enriched
            WHERE NOT coalesce(account_status = 'CLOSED' OR base_currency_balance = 0 OR product_description IS NULL
                               OR rate_missing OR customer_id IS NULL, FALSE)
              AND NOT EXISTS (SELECT 1 FROM {critical} k WHERE k.customer_id = {p}enriched.customer_id))""",
        f"""{p}portfolio_rows AS (SELECT *, {band_sql} AS portfolio_value_band,
              coalesce(base_currency_balance >= {specs.HIGH_VALUE_MINIMUM}, FALSE) AS high_value_customer,
              CAST(count(*) OVER (PARTITION BY business_date, customer_id) AS INTEGER) AS product_count FROM {p}included)""",
        f"""{p}portfolio AS (SELECT business_date, source_system_code, source_account_number, customer_id, customer_name,
              customer_category, branch_code, product_code, product_description, product_category, regulatory_category,
              currency_code, exchange_rate, account_balance, base_currency_balance, account_status, eligible_for_reporting,
              portfolio_value_band, high_value_customer, product_count FROM {p}portfolio_rows)""",
    ] + rule_ctes(f"{p}portfolio_rows", f"{p}exc", hash_expr, esc) \
      + rule_ctes(f"{p}enriched", f"{p}stexc", hash_expr, esc)


def rule_ctes(frame: str, out: str, hash_expr: str, esc: str) -> list[str]:
    def hit(code, cond, value):
        return (f"SELECT business_date, source_system_code, source_account_number, customer_id, '{code}' AS rule_code, "
                f"CAST({value} AS VARCHAR) AS exception_value FROM {out}_in WHERE {cond}")
    hits = " UNION ALL ".join([
        hit("DQ001", "NOT in_master AND customer_id IS NOT NULL", "customer_id"),
        hit("DQ002", "product_description IS NULL", "product_code"),
        hit("DQ003", "rate_missing", "currency_code"),
        hit("DQ004", "base_currency_balance < 0", "base_currency_balance"),
        hit("DQ005", "account_status = 'CLOSED' AND eligible_for_reporting = 'Y'", "account_status"),
        hit("DQ006", "dup_n > 1", "source_account_number"),
    ])
    return [
        f"{out}_in AS (SELECT *, count(*) OVER (PARTITION BY business_date, source_account_number) AS dup_n FROM {frame})",
        f"{out}_hits AS ({hits})",
        f"""{out}_staged AS (SELECT h.business_date, h.source_system_code, h.source_account_number, h.customer_id, h.rule_code,
              r.exception_category, r.rule_text AS exception_description, h.exception_value, r.severity_code,
              r.business_area, o.business_owner, TIMESTAMP '{AS_OF}' AS logged_date
            FROM {out}_hits h JOIN cfg_rules r ON h.rule_code = r.rule_code AND r.rule_enabled
            LEFT JOIN cfg_owners o ON r.business_area = o.business_area)""",
        f"""{out}_dedup AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
              PARTITION BY business_date, customer_id, rule_code, exception_value
              ORDER BY logged_date DESC, source_system_code ASC NULLS LAST, source_account_number ASC NULLS LAST) AS rn
            FROM {out}_staged) WHERE rn = 1)""",
        f"""{out} AS (SELECT d.business_date, d.source_system_code, d.source_account_number, d.customer_id, d.rule_code,
              d.exception_category, d.exception_description, d.exception_value, d.severity_code, s.priority_level,
              s.sla_hours, s.escalation_required, {esc} AS escalation_queue, d.business_area, d.business_owner,
              {hash_expr} AS exception_hash, d.logged_date, d.logged_date + to_hours(s.sla_hours) AS resolution_due_date
            FROM {out}_dedup d LEFT JOIN cfg_severity s ON d.severity_code = s.severity_code)""",
    ]


def customer_issue_selects() -> str:
    """Issues that name a customer (mirror of testdata.customer_issues)."""
    def issue(cond, category, text):
        return (f"SELECT DATE '{BD}' AS business_date, 'CORE_BANKING' AS source_system, "
                f"'CUST' || CAST(c_custkey AS VARCHAR) AS customer_id, '{category}' AS error_category, "
                f"'{text}' AS error_description, TIMESTAMP '{AS_OF}' AS logged_date, "
                f"CAST(NULL AS VARCHAR) AS execution_id FROM customer WHERE {cond}")
    return " UNION ALL ".join([
        issue("c_acctbal < 0", "Financial Validation", "Customer overdrawn"),
        issue("c_mktsegment = 'MACHINERY'", "Product Validation", "Segment without products"),
        issue("c_mktsegment = 'HOUSEHOLD'", "Customer Review", "Review due")])


def customer_exception_ctes(p: str = "", ids: str | None = None, extra: str = "") -> list[str]:
    ids = ids or f"{p}ids_clean"
    d = specs.UNCLASSIFIED_DEFAULTS
    cat, text = specs.ERR_MISSING_CUSTOMER_ID
    lvl = "CASE " + " ".join(f"WHEN severity_code = '{s}' THEN {v}" for s, v in specs.ESCALATION_LEVELS) \
        + f" ELSE {specs.ESCALATION_LEVEL_OTHERWISE} END"
    return [
        f"""{p}dq_issues AS (SELECT DATE '{BD}' AS business_date, source_system_code AS source_system,
              CAST(NULL AS VARCHAR) AS customer_id, '{cat}' AS error_category, '{text}' AS error_description,
              TIMESTAMP '{AS_OF}' AS logged_date, CAST(NULL AS VARCHAR) AS execution_id
            FROM {ids} WHERE customer_id IS NULL{extra})""",
        f"""{p}issues_dedup AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
              PARTITION BY customer_id, error_category, error_description
              ORDER BY logged_date DESC, source_system ASC NULLS LAST, execution_id ASC NULLS LAST) AS rn
            FROM {p}dq_issues) WHERE rn = 1)""",
        f"""{p}issues_classified AS (SELECT i.customer_id, i.source_system AS source_system_code,
              i.error_category AS exception_category, i.error_description AS exception_description,
              CASE WHEN c.exception_category IS NOT NULL THEN s.severity_code ELSE '{d['severity_code']}' END AS severity_code,
              CASE WHEN c.exception_category IS NOT NULL THEN 'Severity: ' || s.severity_code ELSE '{d['severity_description']}' END AS severity_description,
              CASE WHEN c.exception_category IS NOT NULL THEN s.escalation_required ELSE {q(d['escalation_required'])} END AS escalation_required,
              CAST(CASE WHEN c.exception_category IS NOT NULL THEN s.sla_hours ELSE {d['resolution_target_hours']} END AS INTEGER) AS resolution_target_hours,
              CASE WHEN c.exception_category IS NOT NULL THEN c.business_area ELSE '{d['business_area']}' END AS business_area,
              CASE WHEN c.exception_category IS NOT NULL THEN o.business_owner ELSE '{d['business_owner']}' END AS business_owner,
              CASE WHEN c.exception_category IS NOT NULL THEN o.support_team ELSE '{d['support_team']}' END AS support_team,
              i.logged_date, DATE '{BD}' AS business_date, 'OPEN' AS exception_status,
              TIMESTAMP '{AS_OF}' AS assigned_date, 'PENDING' AS resolution_status
            FROM {p}issues_dedup i LEFT JOIN cfg_categories c ON i.error_category = c.exception_category
            LEFT JOIN cfg_severity s ON c.default_severity = s.severity_code
            LEFT JOIN cfg_owners o ON c.business_area = o.business_area
            WHERE c.exception_category IS NULL OR s.severity_code IS NOT NULL)""",
        f"""{p}customer_exceptions AS (SELECT business_date, customer_id, source_system_code, exception_category,
              CASE WHEN severity_code = 'CRITICAL' THEN '[CRITICAL] ' || exception_description ELSE exception_description END AS exception_description,
              severity_code, severity_description, escalation_required, resolution_target_hours, business_area,
              business_owner, support_team, logged_date, exception_status, assigned_date, resolution_status,
              {lvl} AS escalation_level, logged_date + to_hours(resolution_target_hours) AS resolution_due_date
            FROM {p}issues_classified)""",
        f"""{p}critical_customers AS (SELECT DISTINCT customer_id FROM {p}customer_exceptions
            WHERE exception_status = 'OPEN' AND severity_code = 'CRITICAL' AND customer_id IS NOT NULL)""",
    ]


def base_ctes() -> list[str]:
    return (config_ctes() + source_ctes() + master_ctes() + upsert_master_ctes()
            + customer_exception_ctes() + pipeline_ctes())


def count_filters(sql: str) -> str:
    """``count_if(c)`` -> ``count(*) FILTER (WHERE c)``: 0, not NULL, when no row qualifies."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        out.append(sql[i:j])
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(f"(count(*) FILTER (WHERE {count_filters(sql[j + len(key):k - 1])}))")
        i = k


def with_ctes(ctes: list[str], select: str) -> str:
    return count_filters("WITH " + ",\n".join(ctes) + "\n" + select)


# ---------------------------------------------------------------------------
# KPI / report CTEs for a (portfolio, exceptions) pair
# ---------------------------------------------------------------------------

def kpi_ctes(p: str, portfolio: str, exc: str) -> list[str]:
    crit = "count_if(severity_code = 'CRITICAL')"
    health = ("CASE WHEN exception_rate IS NULL THEN 'NO DATA' "
              + " ".join(f"WHEN exception_rate < {b} THEN '{lbl}'" for b, lbl in specs.HEALTH_LADDER)
              + f" ELSE '{specs.HEALTH_OTHERWISE}' END")
    status = ("CASE " + " ".join(f"WHEN {sev.lower()}_exceptions > {n} THEN '{lbl}'" for sev, n, lbl in specs.EXECUTIVE_STATUS)
              + f" ELSE '{specs.EXECUTIVE_OTHERWISE}' END")
    t = {x.metric: x for x in specs.THRESHOLDS}

    def rag(v, th):
        return f"CASE WHEN {v} < {th.green} THEN 'GREEN' WHEN {v} < {th.amber} THEN 'AMBER' ELSE 'RED' END"

    sla_t = t["SLA Failure Rate"]
    return [
        f"""{p}totals AS (SELECT coalesce(a.business_date, e.business_date) AS business_date,
              CAST(coalesce(a.total_accounts, 0) AS BIGINT) AS total_accounts,
              CAST(coalesce(a.total_customers, 0) AS BIGINT) AS total_customers,
              CAST(coalesce(e.total_exceptions, 0) AS BIGINT) AS total_exceptions,
              CAST(coalesce(e.critical_exceptions, 0) AS BIGINT) AS critical_exceptions,
              CAST(coalesce(e.high_exceptions, 0) AS BIGINT) AS high_exceptions,
              CAST(coalesce(e.medium_exceptions, 0) AS BIGINT) AS medium_exceptions,
              CAST(coalesce(e.low_exceptions, 0) AS BIGINT) AS low_exceptions
            FROM (SELECT business_date, count(*) AS total_accounts, count(DISTINCT customer_id) AS total_customers
                  FROM {portfolio} GROUP BY business_date) a
            FULL OUTER JOIN (SELECT business_date, count(*) AS total_exceptions, {crit} AS critical_exceptions,
                  count_if(severity_code = 'HIGH') AS high_exceptions, count_if(severity_code = 'MEDIUM') AS medium_exceptions,
                  count_if(severity_code = 'LOW') AS low_exceptions FROM {exc} GROUP BY business_date) e
            ON a.business_date = e.business_date)""",
        f"{p}exec_totals AS (SELECT *, {pct('total_exceptions', 'total_accounts')} AS exception_rate FROM {p}totals)",
        f"{p}health AS (SELECT *, {health} AS portfolio_health, {status} AS executive_status FROM {p}exec_totals)",
        f"""{p}sla AS (SELECT business_date, severity_code, count(*) AS total_exceptions,
              count_if(resolution_due_date < TIMESTAMP '{REPORT_AS_OF}') AS overdue_exceptions,
              count_if(escalation_required) AS escalated_exceptions,
              {pct("count_if(resolution_due_date < TIMESTAMP '" + REPORT_AS_OF + "')", 'count(*)')} AS sla_failure_rate
            FROM {exc} GROUP BY business_date, severity_code)""",
        f"""{p}sla_day AS (SELECT business_date, CAST(sum(CAST(sla_failure_rate * 100 AS BIGINT)) AS HUGEINT) AS fail_h,
              CAST(count(*) AS HUGEINT) AS n_groups FROM {p}sla GROUP BY business_date)""",
        f"""{p}score_base AS (SELECT h.*,
              CASE WHEN s.n_groups IS NULL THEN CAST(100 AS DECIMAL(10,2))
                   ELSE CAST(CAST(((10000 * s.n_groups - s.fail_h) * 2 + s.n_groups) // (2 * s.n_groups) AS DECIMAL(20,0))
                             * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) END AS sla_compliance,
              CASE WHEN s.n_groups IS NULL OR s.fail_h < {int(sla_t.green * 100)} * s.n_groups THEN 'GREEN'
                   WHEN s.fail_h < {int(sla_t.amber * 100)} * s.n_groups THEN 'AMBER' ELSE 'RED' END AS sla_status
            FROM {p}health h LEFT JOIN {p}sla_day s ON h.business_date = s.business_date)""",
        f"""{p}scorecard AS (
            SELECT business_date, 'Portfolio Health' AS kpi_name, portfolio_health AS kpi_value,
                   CASE WHEN portfolio_health IN ('EXCELLENT', 'GOOD') THEN 'GREEN' WHEN portfolio_health = 'FAIR' THEN 'AMBER'
                        WHEN portfolio_health = 'NO DATA' THEN 'NO DATA' ELSE 'RED' END AS kpi_status FROM {p}score_base
            UNION ALL SELECT business_date, 'Critical Exceptions', CAST(critical_exceptions AS VARCHAR),
                   {rag('critical_exceptions', t['Critical Exceptions'])} FROM {p}score_base
            UNION ALL SELECT business_date, 'Exception Rate', CAST(exception_rate AS VARCHAR),
                   CASE WHEN exception_rate IS NULL THEN 'NO DATA' ELSE {rag('exception_rate', t['Exception Rate'])} END
                   FROM {p}score_base
            UNION ALL SELECT business_date, 'SLA Compliance', CAST(sla_compliance AS VARCHAR), sla_status FROM {p}score_base)""",
    ]


def error_select(frame: str, cond: str, category: str, description: str, customer: str = "customer_id") -> str:
    return (f"SELECT business_date, source_system_code, source_account_number, {customer} AS customer_id, "
            f"'{category}' AS error_category, {description} AS error_description, TIMESTAMP '{AS_OF}' AS logged_date, "
            f"CAST(NULL AS VARCHAR) AS execution_id FROM {frame} WHERE {cond}")


def error_ctes() -> list[str]:
    raw = " UNION ALL ".join([
        error_select("clean", "customer_id IS NULL", *specs.ERR_MISSING_CUSTOMER[:1],
                     q(specs.ERR_MISSING_CUSTOMER[1]), "CAST(NULL AS VARCHAR)"),
        error_select("clean", "product_code IS NULL", specs.ERR_MISSING_PRODUCT[0], q(specs.ERR_MISSING_PRODUCT[1])),
        error_select("clean", "account_balance IS NULL", specs.ERR_INVALID_BALANCE[0], q(specs.ERR_INVALID_BALANCE[1])),
    ])
    return [
        f"raw_errors AS (SELECT DISTINCT * FROM ({raw}))",
        "missing_fx AS (" + error_select("enriched", "rate_missing", specs.ERR_MISSING_FX[0],
                                         f"{q(specs.ERR_MISSING_FX[1])} || currency_code") + ")",
        "unknown_product AS (" + error_select("enriched", "product_description IS NULL", specs.ERR_UNKNOWN_PRODUCT[0],
                                              f"{q(specs.ERR_UNKNOWN_PRODUCT[1])} || coalesce(product_code, '')") + ")",
        "customer_not_found AS (" + error_select("enriched", "customer_id IS NOT NULL AND NOT in_master",
                                                 *specs.ERR_CUSTOMER_NOT_FOUND[:1], q(specs.ERR_CUSTOMER_NOT_FOUND[1])) + ")",
        "negative_portfolio AS (" + error_select("portfolio", f"base_currency_balance < {specs.NEGATIVE_PORTFOLIO_LIMIT}",
                                                 specs.ERR_NEGATIVE_PORTFOLIO[0], q(specs.ERR_NEGATIVE_PORTFOLIO[1])) + ")",
        """portfolio_errors AS (SELECT * FROM raw_errors UNION ALL SELECT * FROM missing_fx UNION ALL SELECT * FROM unknown_product
            UNION ALL SELECT * FROM customer_not_found UNION ALL SELECT * FROM negative_portfolio)""",
    ]


EXC_COLS = ["business_date", "source_system_code", "source_account_number", "customer_id", "rule_code",
            "exception_category", "exception_description", "exception_value", "severity_code",
            "priority_level", "sla_hours", "escalation_required", "escalation_queue", "business_area",
            "business_owner", "exception_hash", "logged_date", "resolution_due_date"]


def loose_equal(a: str, b: str) -> str:
    na = f"TRY_CAST(replace(trim({a}), '%', '') AS DECIMAL(38,10))"
    nb = f"TRY_CAST(replace(trim({b}), '%', '') AS DECIMAL(38,10))"
    return (f"CASE WHEN {na} IS NOT NULL AND {nb} IS NOT NULL THEN abs({na} - {nb}) < 0.1 "
            f"ELSE coalesce(upper(trim({a})), '') = coalesce(upper(trim({b})), '') END")


def recon_ctes() -> list[str]:
    return [
        """recon_counts AS (SELECT * , coalesce(baseline_count = current_count, FALSE) AS count_match FROM
            (SELECT 'portfolio' AS dataset, count(*) AS baseline_count FROM portfolio
             UNION ALL SELECT 'exceptions', count(*) FROM exc UNION ALL SELECT 'report', count(*) FROM scorecard) b
            FULL OUTER JOIN
            (SELECT 'portfolio' AS dataset, count(*) AS current_count FROM cur_portfolio
             UNION ALL SELECT 'exceptions', count(*) FROM cur_exc UNION ALL SELECT 'report', count(*) FROM cur_scorecard) c
            USING (dataset))""",
        """recon_aggregates AS (SELECT *, CAST(baseline_total_balance - current_total_balance AS DECIMAL(28,2)) AS balance_difference,
              abs(baseline_total_balance - current_total_balance) < 0.01 AS balance_match,
              baseline_total_accounts = current_total_accounts AS accounts_match,
              baseline_total_customers = current_total_customers AS customers_match
            FROM (SELECT 'customer_portfolio' AS dataset, CAST(coalesce(sum(base_currency_balance), 0) AS DECIMAL(28,2)) AS baseline_total_balance,
                         count(source_account_number) AS baseline_total_accounts, count(DISTINCT customer_id) AS baseline_total_customers
                  FROM portfolio) b
            JOIN (SELECT 'customer_portfolio' AS dataset, CAST(coalesce(sum(base_currency_balance), 0) AS DECIMAL(28,2)) AS current_total_balance,
                         count(source_account_number) AS current_total_accounts, count(DISTINCT customer_id) AS current_total_customers
                  FROM cur_portfolio) c USING (dataset))""",
        """recon_by_severity AS (SELECT coalesce(b.severity_code, c.severity_code) AS severity_code,
              coalesce(b.n, 0) AS baseline_count, coalesce(c.n, 0) AS current_count, coalesce(b.n, 0) = coalesce(c.n, 0) AS count_match
            FROM (SELECT severity_code, count(*) AS n FROM exc GROUP BY 1) b
            FULL OUTER JOIN (SELECT severity_code, count(*) AS n FROM cur_exc GROUP BY 1) c
            ON b.severity_code IS NOT DISTINCT FROM c.severity_code)""",
        """recon_by_rule AS (SELECT coalesce(b.rule_code, c.rule_code) AS rule_code, coalesce(b.severity_code, c.severity_code) AS severity_code,
              coalesce(b.n, 0) AS baseline_count, coalesce(c.n, 0) AS current_count, coalesce(b.n, 0) = coalesce(c.n, 0) AS count_match
            FROM (SELECT rule_code, severity_code, count(*) AS n FROM exc GROUP BY 1, 2) b
            FULL OUTER JOIN (SELECT rule_code, severity_code, count(*) AS n FROM cur_exc GROUP BY 1, 2) c
            ON b.rule_code IS NOT DISTINCT FROM c.rule_code AND b.severity_code IS NOT DISTINCT FROM c.severity_code)""",
        """recon_hash_diff AS (SELECT coalesce(b.h, c.h) AS exception_hash,
              CASE WHEN b.h IS NOT NULL AND c.h IS NOT NULL THEN 'BOTH' WHEN b.h IS NOT NULL THEN 'BASELINE_ONLY' ELSE 'CURRENT_ONLY' END AS hash_status,
              CASE WHEN b.h IS NOT NULL THEN b.source_account_number ELSE c.source_account_number END AS source_account_number,
              CASE WHEN b.h IS NOT NULL THEN b.customer_id ELSE c.customer_id END AS customer_id,
              CASE WHEN b.h IS NOT NULL THEN b.rule_code ELSE c.rule_code END AS rule_code,
              CASE WHEN b.h IS NOT NULL THEN b.severity_code ELSE c.severity_code END AS severity_code
            FROM (SELECT upper(exception_hash) AS h, source_account_number, customer_id, rule_code, severity_code FROM exc) b
            FULL OUTER JOIN (SELECT upper(exception_hash) AS h, source_account_number, customer_id, rule_code, severity_code FROM cur_exc) c
            ON b.h = c.h)""",
        f"""recon_kpis AS (SELECT *, coalesce({loose_equal('baseline_value', 'current_value')}, FALSE) AS value_match,
              coalesce(upper(baseline_status) = upper(current_status), FALSE) AS status_match
            FROM (SELECT business_date, kpi_name, kpi_value AS baseline_value, kpi_status AS baseline_status FROM scorecard) b
            FULL OUTER JOIN (SELECT business_date, kpi_name, kpi_value AS current_value, kpi_status AS current_status
                             FROM cur_scorecard) c
            USING (business_date, kpi_name))""",
        """recon_missing_extra AS (SELECT business_date, source_system_code, source_account_number,
              CASE WHEN _c IS NULL THEN 'MISSING' ELSE 'EXTRA' END AS row_status
            FROM (SELECT DISTINCT business_date, source_system_code, source_account_number, TRUE AS _b FROM portfolio
                  WHERE source_system_code <> 'MORTGAGE') b
            FULL OUTER JOIN (SELECT DISTINCT business_date, source_system_code, source_account_number, TRUE AS _c FROM ci_portfolio) c
            USING (business_date, source_system_code, source_account_number)
            WHERE _b IS NULL OR _c IS NULL)""",
        """recon_checks_raw AS (
            SELECT dataset || '_row_count' AS check_name, CAST(baseline_count AS VARCHAR) AS baseline_value,
                   CAST(current_count AS VARCHAR) AS current_value, coalesce(count_match, FALSE) AS passed,
                   dataset <> 'report' AS in_verdict,
                   CASE dataset WHEN 'portfolio' THEN 'portfolio load' WHEN 'exceptions' THEN 'rule engine' ELSE 'report' END AS stage
            FROM recon_counts
            UNION ALL SELECT 'portfolio_balance', CAST(baseline_total_balance AS VARCHAR), CAST(current_total_balance AS VARCHAR),
                   coalesce(balance_match, FALSE), TRUE, 'currency conversion' FROM recon_aggregates
            UNION ALL SELECT 'portfolio_accounts', CAST(baseline_total_accounts AS VARCHAR), CAST(current_total_accounts AS VARCHAR),
                   coalesce(accounts_match, FALSE), FALSE, 'inclusion rules' FROM recon_aggregates
            UNION ALL SELECT 'portfolio_customers', CAST(baseline_total_customers AS VARCHAR), CAST(current_total_customers AS VARCHAR),
                   coalesce(customers_match, FALSE), FALSE, 'customer enrichment' FROM recon_aggregates
            UNION ALL SELECT 'exceptions_by_rule', CAST(sum(baseline_count) AS VARCHAR), CAST(sum(current_count) AS VARCHAR),
                   coalesce(bool_and(count_match), FALSE), TRUE, 'rule engine' FROM recon_by_rule
            UNION ALL SELECT 'exception_hashes', CAST(count_if(hash_status <> 'CURRENT_ONLY') AS VARCHAR),
                   CAST(count_if(hash_status <> 'BASELINE_ONLY') AS VARCHAR),
                   coalesce(coalesce(bool_and(hash_status = 'BOTH'), TRUE), FALSE), TRUE, 'exception hashing' FROM recon_hash_diff
            UNION ALL SELECT 'kpi_values', CAST(count(baseline_value) AS VARCHAR), CAST(count(current_value) AS VARCHAR),
                   coalesce(coalesce(bool_and(value_match), TRUE), FALSE), TRUE, 'report' FROM recon_kpis)""",
        """recon_checks AS (SELECT *, CASE WHEN NOT passed THEN 'check ' || check_name || ' failed: baseline=' ||
              coalesce(baseline_value, 'NULL') || ' current=' || coalesce(current_value, 'NULL') || '; inspect ' || stage
              || '; known causes: ' || (CASE stage """ + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in KNOWN_CAUSES.items()) + """ END) END AS explanation
            FROM recon_checks_raw)""",
    ]


def runlog_select() -> str:
    stages = [
        ("load_customer_master", "(SELECT count(*) FROM ids)",
         "(SELECT count_if(_action = 'INSERT') FROM master_upsert)", "(SELECT count_if(_action = 'UPDATE') FROM master_upsert)",
         "(SELECT count(*) FROM dq_issues)"),
        ("load_customer_exceptions", "(SELECT count(*) FROM dq_issues)", "(SELECT count(*) FROM customer_exceptions)", "0", "0"),
        ("load_customer_portfolio", "(SELECT count(*) FROM staged)", "(SELECT count(*) FROM portfolio)", "0",
         "(SELECT count(*) FROM portfolio_errors)"),
        ("load_portfolio_exceptions", "(SELECT count(*) FROM portfolio)", "(SELECT count(*) FROM exc)", "0", "0"),
        ("load_exception_report", "(SELECT count(*) FROM exc)", "(SELECT count(*) FROM scorecard)", "0", "0"),
    ]
    parts = []
    for i, (name, r, ins, upd, rej) in enumerate(stages):
        parts.append(
            f"SELECT 'RUN-2026-01-31' AS execution_id, '{name}' AS procedure_name, DATE '{BD}' AS business_date, "
            f"'FULL' AS load_type, TIMESTAMP '{AS_OF}' + INTERVAL {i * 10} MINUTE AS start_time, "
            f"TIMESTAMP '{AS_OF}' + INTERVAL {i * 600 + 300} SECOND AS end_time, 'SUCCESS' AS status, "
            f"CAST({r} AS BIGINT) AS rows_read, CAST({ins} AS BIGINT) AS rows_inserted, CAST({upd} AS BIGINT) AS rows_updated, "
            f"CAST({rej} AS BIGINT) AS rows_rejected, CAST(300 AS BIGINT) AS duration_seconds, 'completed' AS message")
    return " UNION ALL ".join(parts)


def _oracle() -> dict[str, str]:
    base = base_ctes() + error_ctes() + kpi_ctes("", "portfolio", "exc")
    inc = pipeline_ctes("inc_", load_type="INCREMENTAL") + kpi_ctes("inc_", "inc_portfolio", "inc_exc")
    trend_pred = f"{{col}} BETWEEN DATE '{TREND_FROM}' AND DATE '{TREND_DATE}'"
    trend = pipeline_ctes("tr_", date_pred=trend_pred)
    history = pipeline_ctes("hi_", date_pred="{col} BETWEEN DATE '1900-01-01' AND DATE '2100-12-31'")
    with_issues = (customer_exception_ctes("ci_", ids="ids_clean", extra=" UNION ALL " + customer_issue_selects())
                   + pipeline_ctes("ci_", critical="ci_critical_customers"))
    allm = master_ctes(include=[s.code for s in specs.SOURCES], prefix="all_")
    cur = (allm + upsert_master_ctes("all_") + pipeline_ctes("cur_", master="all_customer_master")
           + kpi_ctes("cur_", "cur_portfolio", "cur_exc"))
    recon = base + cur + with_issues + recon_ctes()
    trend_cur = (allm + upsert_master_ctes("all_") + kpi_ctes("tr_", "tr_portfolio", "tr_exc")
                 + pipeline_ctes("trc_", date_pred=trend_pred, master="all_customer_master")
                 + kpi_ctes("trc_", "trc_portfolio", "trc_exc"))
    ce_cols = ["business_date", "customer_id", "source_system_code", "exception_category", "exception_description",
               "severity_code", "severity_description", "escalation_required", "resolution_target_hours",
               "business_area", "business_owner", "support_team", "logged_date", "exception_status",
               "assigned_date", "resolution_status", "escalation_level", "resolution_due_date"]
    ce_keys = ["business_date", "customer_id", "exception_category"]
    issue_table = """issue_table AS (SELECT * REPLACE (CASE WHEN exception_category = 'Product Validation'
          AND customer_id LIKE '%5' THEN 'Reassigned' ELSE business_owner END AS business_owner)
        FROM ci_customer_exceptions WHERE exception_category <> 'Customer Review')"""
    issues_upsert = upsert_sql("issues_upsert", "issue_table", "ci_customer_exceptions", ce_keys, ce_cols,
                               {"severity_code": "''", "exception_description": "''", "business_owner": "''"},
                               [c for c in ce_cols if c not in ce_keys + ["assigned_date"]], False,
                               null_safe_keys=True)
    pf_cols = ["business_date", "source_system_code", "source_account_number", "customer_id", "customer_name",
               "customer_category", "branch_code", "product_code", "product_description", "product_category",
               "regulatory_category", "currency_code", "exchange_rate", "account_balance", "base_currency_balance",
               "account_status", "eligible_for_reporting", "portfolio_value_band", "high_value_customer", "product_count"]
    pf_keys = ["business_date", "customer_id", "source_account_number"]
    pf_rest = ", ".join(f"{c} ASC NULLS LAST" for c in pf_cols if c not in (*pf_keys, "account_balance"))
    pf_one = f"""pf_one AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(pf_keys)}
          ORDER BY account_balance DESC NULLS LAST, {pf_rest}) AS rn FROM portfolio) WHERE rn = 1)"""
    pf_table = """pf_table AS (SELECT * REPLACE (CAST(CASE WHEN source_system_code = 'CARDS' THEN 0 ELSE account_balance END
          AS DECIMAL(18,2)) AS account_balance) FROM pf_one WHERE source_system_code <> 'MORTGAGE')"""
    pf_upsert = upsert_sql("pf_upsert", "pf_table", "pf_one", pf_keys, pf_cols,
                           {"account_balance": "0", "account_status": "''", "customer_name": "''"},
                           [c for c in pf_cols if c not in pf_keys], False, null_safe_keys=True)
    sev_cols = ("count(*) AS total_exceptions, count_if(severity_code = 'CRITICAL') AS critical_exceptions, "
                "count_if(severity_code = 'HIGH') AS high_exceptions, count_if(severity_code = 'MEDIUM') AS medium_exceptions, "
                "count_if(severity_code = 'LOW') AS low_exceptions, count_if(escalation_required) AS escalated_exceptions")
    exc_upd = [c for c in EXC_COLS if c not in ("business_date", "exception_hash")]
    exc_upsert = upsert_sql("exc_upsert", "stexc", "exc", ["business_date", "exception_hash"], EXC_COLS,
                            {"severity_code": "''", "exception_description": "''", "source_account_number": "''"},
                            exc_upd, False)
    src_names = [("core_banking_accounts", "src_core"), ("loan_accounts", "src_loans"), ("card_accounts", "src_cards"),
                 ("investment_accounts", "src_inv"), ("mortgage_accounts", "src_mort"), ("mobile_wallet", "src_mobile"),
                 ("forex_accounts", "src_forex"), ("customer_master", "customer_master"),
                 ("customer_portfolio", "portfolio"), ("customer_portfolio_exceptions", "exc")]
    all_ids = " UNION ".join(f"SELECT {blank_null('CAST(' + cust + ' AS VARCHAR)')} AS customer_id FROM {cte}"
                             for code, cte, prio, acct, cust, *_ in SOURCE_MAP)
    w = with_ctes
    o: dict[str, str] = {
        "extract_union": w(base, "SELECT * FROM staged"),
        "extract_incremental": w(base + inc, "SELECT * FROM inc_staged"),
        "cleanse": w(base, "SELECT * FROM clean"),
        "table_counts": w(base, " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {c}"
                                                   for n, c in src_names)),
        "reject_split": w(base, "SELECT * FROM dq_issues"),
        "master_first_pass": w(base, "SELECT * FROM new_master"),
        "master_all": w(base + allm, "SELECT * FROM all_new_master"),
        "master_dedupe_counts": w(base, """SELECT (SELECT count(*) FROM ids_clean) AS rows_read,
            (SELECT count(*) FROM ids_clean WHERE customer_id IS NULL) AS rows_rejected,
            (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT customer_id, count(*) AS n FROM ids_clean
              WHERE customer_id IS NOT NULL GROUP BY 1)) AS duplicates_removed,
            (SELECT count(DISTINCT customer_id) FROM ids_clean) AS customers"""),
        "upsert_master": w(base, "SELECT * FROM master_upsert"),
        "upsert_metrics": w(base, "SELECT _action AS action, count(*) AS row_count FROM master_upsert GROUP BY 1"),
        "delete_stale": w(base, "SELECT * FROM seed_master WHERE customer_id IN (SELECT customer_id FROM new_master)"),
        "customer_master": w(base, "SELECT * FROM customer_master"),
        "issues_dedup": w(base, "SELECT * FROM issues_dedup"),
        "issues_classified": w(base, "SELECT * FROM customer_exceptions"),
        "customer_severity_summary": w(base, f"SELECT business_date, {sev_cols} FROM customer_exceptions GROUP BY 1"),
        "raw_errors": w(base, "SELECT * FROM raw_errors"),
        "fx_convert": w(base, """SELECT business_date, source_system_code, source_account_number, currency_code, account_balance,
            exchange_rate, base_currency_balance, rate_found, rate_missing FROM conv"""),
        "missing_fx": w(base, "SELECT * FROM missing_fx"),
        "unknown_product": w(base, "SELECT * FROM unknown_product"),
        "customer_not_found": w(base, "SELECT * FROM customer_not_found"),
        "portfolio": w(base, "SELECT * FROM portfolio"),
        "portfolio_incremental": w(base + inc, "SELECT * FROM inc_portfolio"),
        "value_band": w(base, """SELECT portfolio_value_band, count(*) AS account_count,
            CAST(sum(base_currency_balance) AS DECIMAL(28,2)) AS total_value FROM portfolio GROUP BY 1"""),
        "dated_bands": w(base + trend, f"""SELECT business_date, CASE {' '.join(
                f"WHEN base_currency_balance * k >= {b.minimum} THEN '{b.name}'"
                for b in sorted(specs.VALUE_BANDS, key=lambda b: -b.minimum)[:-1])} ELSE 'STANDARD' END AS portfolio_value_band,
              coalesce(base_currency_balance * k >= {specs.HIGH_VALUE_MINIMUM}, FALSE) AS high_value_customer,
              count(*) AS account_count, CAST(sum(base_currency_balance) AS DECIMAL(28,2)) AS total_value
            FROM (SELECT *, CASE WHEN business_date >= DATE '{TREND_DATE}' - 10 THEN 100 ELSE 1 END AS k FROM tr_portfolio)
            GROUP BY ALL"""),
        "high_value": w(base, """SELECT source_system_code, source_account_number, customer_id, base_currency_balance,
            portfolio_value_band FROM portfolio WHERE high_value_customer"""),
        "product_count": w(base, "SELECT DISTINCT customer_id, product_count FROM portfolio"),
        "negative_portfolio": w(base, "SELECT * FROM negative_portfolio"),
        "portfolio_errors": w(base, "SELECT * FROM portfolio_errors"),
        "portfolio_summary": w(base, """SELECT s.business_date, s.total_customers, s.total_accounts, s.total_portfolio_value,
              coalesce(e.errors, 0) AS errors, coalesce(e.rows_with_error, 0) AS rows_with_error
            FROM (SELECT business_date, count(DISTINCT customer_id) AS total_customers, count(*) AS total_accounts,
                         CAST(sum(base_currency_balance) AS DECIMAL(28,2)) AS total_portfolio_value FROM portfolio GROUP BY 1) s
            LEFT JOIN (SELECT business_date, count(*) AS errors,
                         count(DISTINCT CASE WHEN source_system_code IS NOT NULL AND source_account_number IS NOT NULL
                                        THEN source_system_code || chr(1) || source_account_number END) AS rows_with_error
                       FROM portfolio_errors GROUP BY 1) e ON s.business_date = e.business_date"""),
        "value_by_category": w(base, """SELECT business_date, product_category, count(*) AS account_count,
            CAST(sum(base_currency_balance) AS DECIMAL(28,2)) AS total_value FROM portfolio GROUP BY 1, 2"""),
        "branch_summary": w(base, """SELECT business_date, branch_code, count(DISTINCT customer_id) AS customer_count,
            count(*) AS account_count, CAST(sum(base_currency_balance) AS DECIMAL(28,2)) AS total_value
            FROM portfolio GROUP BY 1, 2"""),
        "exceptions_union": w(base, "SELECT * FROM exc_staged"),
        "exceptions_dedup": w(base, "SELECT * FROM exc_dedup"),
        "exception_counts": w(base, """SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS exceptions_found, count(*) AS exceptions_kept,
            CAST(coalesce(sum(n), 0) - count(*) AS BIGINT) AS duplicates_removed
            FROM (SELECT count(*) AS n FROM exc_staged GROUP BY business_date, customer_id, rule_code, exception_value)"""),
        "exceptions": w(base, "SELECT * FROM exc"),
        "exceptions_staged_rows": w(base, "SELECT * FROM stexc"),
        "severity_summary": w(base, f"SELECT business_date, {sev_cols} FROM exc GROUP BY 1"),
        "area_summary": w(base, f"SELECT business_date, business_area, business_owner, {sev_cols} FROM exc GROUP BY 1, 2, 3"),
        "severity_area_dashboard": w(base, """SELECT business_date, severity_code, business_area, count(*) AS exception_count,
            count(DISTINCT customer_id) AS customers_affected,
            count(DISTINCT CASE WHEN source_system_code IS NOT NULL AND source_account_number IS NOT NULL
                  THEN source_system_code || chr(1) || source_account_number END) AS accounts_affected
            FROM exc GROUP BY 1, 2, 3"""),
        "owner_next_due": w(base, """SELECT business_owner, count(*) AS open_exceptions, min(resolution_due_date) AS next_due_date
            FROM exc GROUP BY 1"""),
        "daily_severity": w(base, "SELECT business_date, severity_code, count(*) AS exception_count FROM exc GROUP BY 1, 2"),
        "daily_area": w(base, """SELECT business_date, business_area, count(*) AS exception_count,
            count_if(escalation_required) AS escalated_count FROM exc GROUP BY 1, 2"""),
        "upsert_exceptions": w(base + [exc_upsert], "SELECT * FROM exc_upsert"),
        "upsert_issues": w(base + with_issues + [issue_table, issues_upsert], "SELECT * FROM issues_upsert"),
        "issues_enriched": w(base + with_issues, "SELECT * FROM ci_customer_exceptions"),
        "critical_exclusion": w(base + with_issues, "SELECT * FROM ci_portfolio"),
        "upsert_portfolio": w(base + [pf_one, pf_table, pf_upsert], "SELECT * FROM pf_upsert"),
        "product_count_by_date": w(base + trend, "SELECT DISTINCT business_date, customer_id, product_count FROM tr_portfolio"),
        "recon_kpis_by_date": w(base + trend + trend_cur, f"""SELECT *,
              coalesce({loose_equal('baseline_value', 'current_value')}, FALSE) AS value_match,
              coalesce(upper(baseline_status) = upper(current_status), FALSE) AS status_match
            FROM (SELECT business_date, kpi_name, kpi_value AS baseline_value, kpi_status AS baseline_status FROM tr_scorecard) b
            FULL OUTER JOIN (SELECT business_date, kpi_name, kpi_value AS current_value, kpi_status AS current_status
                             FROM trc_scorecard) c USING (business_date, kpi_name)"""),
        "exception_sample": w(base, """SELECT * FROM exc ORDER BY priority_level ASC NULLS FIRST,
            resolution_due_date ASC NULLS FIRST, exception_hash ASC NULLS FIRST LIMIT 20"""),
        "replace_date": w(base + history, f"""SELECT * FROM hi_exc WHERE business_date IS DISTINCT FROM DATE '{TREND_DATE}'
            UNION ALL SELECT * FROM hi_exc WHERE business_date = DATE '{TREND_DATE}' AND rule_code = 'DQ004'"""),
        "exec_totals": w(base, "SELECT * FROM exec_totals"),
        "health_status": w(base, "SELECT * FROM health"),
        "source_quality": w(base, f"""SELECT a.business_date, a.source_system_code, a.total_accounts,
              coalesce(e.total_exceptions, 0) AS total_exceptions, coalesce(e.critical_exceptions, 0) AS critical_exceptions,
              coalesce(e.high_exceptions, 0) AS high_exceptions,
              {pct('coalesce(e.total_exceptions, 0)', 'a.total_accounts')} AS exception_rate
            FROM (SELECT business_date, source_system_code, count(*) AS total_accounts FROM portfolio GROUP BY 1, 2) a
            LEFT JOIN (SELECT business_date, source_system_code, count(*) AS total_exceptions,
                         count_if(severity_code = 'CRITICAL') AS critical_exceptions, count_if(severity_code = 'HIGH') AS high_exceptions
                       FROM exc GROUP BY 1, 2) e
            ON a.business_date = e.business_date AND a.source_system_code = e.source_system_code"""),
        "source_quality_fanout": w(base, f"""SELECT p.business_date, p.source_system_code, count(*) AS total_accounts,
              count(e.exception_hash) AS total_exceptions, count_if(e.severity_code = 'CRITICAL') AS critical_exceptions,
              {pct('count(e.exception_hash)', 'count(*)')} AS exception_rate
            FROM portfolio p LEFT JOIN exc e ON p.business_date = e.business_date
              AND p.source_account_number = e.source_account_number
            GROUP BY 1, 2"""),
        "area_kpis": w(base, """SELECT business_date, business_area, count(*) AS total_exceptions,
            count_if(severity_code = 'CRITICAL') AS critical_exceptions, count_if(escalation_required) AS escalated_exceptions
            FROM exc GROUP BY 1, 2"""),
        "owner_queue": w(base, """SELECT business_date, business_owner, count(*) AS assigned_exceptions,
            count_if(severity_code = 'CRITICAL') AS critical_exceptions, min(resolution_due_date) AS earliest_due_date,
            max(resolution_due_date) AS latest_due_date FROM exc GROUP BY 1, 2"""),
        "branch_quality": w(base, f"""SELECT a.business_date, a.branch_code, a.total_accounts,
              coalesce(e.exceptions, 0) AS exceptions, {pct('coalesce(e.exceptions, 0)', 'a.total_accounts')} AS branch_exception_rate
            FROM (SELECT business_date, branch_code, count(*) AS total_accounts FROM portfolio GROUP BY 1, 2) a
            LEFT JOIN (SELECT x.business_date, k.branch_code, count(*) AS exceptions FROM exc x
                       JOIN (SELECT DISTINCT business_date, source_system_code, source_account_number, branch_code FROM portfolio) k
                       ON x.business_date = k.business_date AND x.source_system_code = k.source_system_code
                          AND x.source_account_number = k.source_account_number
                       GROUP BY 1, 2) e
            ON a.business_date = e.business_date AND a.branch_code IS NOT DISTINCT FROM e.branch_code"""),
        "sla_performance": w(base, "SELECT * FROM sla"),
        "trend_30d": w(base + trend, f"""SELECT business_date, count(*) AS total_exceptions,
            count_if(severity_code = 'CRITICAL') AS critical_exceptions, count(DISTINCT business_owner) AS active_business_owners
            FROM tr_exc WHERE business_date BETWEEN DATE '{TREND_DATE}' - 30 AND DATE '{TREND_DATE}' GROUP BY 1"""),
        "affected_from_states": w(base + history, """SELECT severity_code, business_area, count(*) AS exception_count,
            count(DISTINCT customer_id) AS customers_affected,
            count(DISTINCT CASE WHEN source_system_code IS NOT NULL AND source_account_number IS NOT NULL
                  THEN source_system_code || chr(1) || source_account_number END) AS accounts_affected
            FROM hi_exc GROUP BY 1, 2"""),
        "trend_from_rollup": w(base + trend, f"""SELECT business_date, count(*) AS total_exceptions,
            count_if(severity_code = 'CRITICAL') AS critical_exceptions, count(DISTINCT business_owner) AS active_business_owners
            FROM tr_exc WHERE business_date BETWEEN DATE '{TREND_DATE}' - 30 AND DATE '{TREND_DATE}' GROUP BY 1"""),
        "scorecard": w(base, "SELECT * FROM scorecard"),
        "executive_dashboard": w(base, "SELECT * EXCLUDE (sla_status) FROM score_base"),
        "recon_counts": w(recon, "SELECT * FROM recon_counts"),
        "recon_aggregates": w(recon, "SELECT * FROM recon_aggregates"),
        "recon_by_severity": w(recon, "SELECT * FROM recon_by_severity"),
        "recon_by_rule": w(recon, "SELECT * FROM recon_by_rule"),
        "recon_hash_diff": w(recon, "SELECT * FROM recon_hash_diff"),
        "recon_digest_diff": w(recon, """SELECT exception_hash, source_account_number, customer_id, rule_code, severity_code,
            'MISSING' AS row_status FROM exc e WHERE NOT EXISTS (SELECT 1 FROM cur_exc c WHERE c.exception_hash = e.exception_hash)
            UNION ALL SELECT exception_hash, source_account_number, customer_id, rule_code, severity_code, 'EXTRA'
            FROM cur_exc c WHERE NOT EXISTS (SELECT 1 FROM exc e WHERE c.exception_hash = e.exception_hash)"""),
        "recon_hash_summary": w(recon, "SELECT hash_status, count(*) AS hash_count FROM recon_hash_diff GROUP BY 1"),
        "recon_kpis": w(recon, "SELECT * FROM recon_kpis"),
        "recon_missing_extra": w(recon, "SELECT * FROM recon_missing_extra"),
        "recon_checks": w(recon, "SELECT * FROM recon_checks"),
        "recon_verdict": w(recon, """SELECT count(*) AS checks, count_if(NOT passed) AS failed_checks,
            CASE WHEN coalesce(bool_and(passed), TRUE) THEN 'PASS' ELSE 'FAIL' END AS verdict FROM recon_checks WHERE in_verdict"""),
        "baseline_snapshot_accounts": w(base, f"""SELECT * FROM customer_master WHERE customer_id IN
            (SELECT customer_id FROM ({all_ids}) WHERE customer_id IS NOT NULL)"""),
        "runlog_latest": w(base + ["ids_all AS (SELECT 1)"], runlog_select()),
        "run_daily": w(base, "SELECT * EXCLUDE (sla_status), 'RUN-2026-01-31' AS execution_id FROM score_base"),
    }
    for code in ("DQ001", "DQ002", "DQ003", "DQ004", "DQ005", "DQ006"):
        o[code.lower()] = w(base, f"SELECT * FROM stexc_staged WHERE rule_code = '{code}'")
    return o


ORACLE = _oracle()
