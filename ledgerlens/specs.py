"""Specs and fixed configuration values.

Everything under "FIXED VALUES" must equal the source system's configuration
rows for results to match (column mappings, products, rates, rules, SLA
table, owners, bands, thresholds, rule texts).  They are kept together and
in their natural order; the engine itself is driven by these specs, so a
deployment can replace any of them with its own config tables.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal


@dataclass(frozen=True)
class SourceSpec:
    """One account system and how its columns map to the canonical names."""

    code: str
    table: str
    priority: int
    account: str
    customer: str
    product: str
    balance: str
    currency: str
    status: str
    date: str
    active: bool = True
    supports_incremental: bool = True


@dataclass(frozen=True)
class RuleSpec:
    code: str
    category: str
    severity: str
    area: str
    enabled: bool = True


@dataclass(frozen=True)
class BandSpec:
    name: str
    minimum: Decimal
    maximum: Decimal


@dataclass(frozen=True)
class ThresholdSpec:
    metric: str
    green: Decimal
    amber: Decimal
    red: Decimal


# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the source system's configuration rows)
# ---------------------------------------------------------------------------

SOURCES: tuple[SourceSpec, ...] = (
    SourceSpec("CORE_BANKING", "core_banking_accounts", 1, "account_number", "customer_number",
               "product_code", "account_balance", "currency", "account_status", "record_date"),
    SourceSpec("LOANS", "loan_accounts", 2, "loan_number", "client_id",
               "loan_product", "outstanding_amount", "loan_currency", "loan_status", "snapshot_date"),
    SourceSpec("CARDS", "card_accounts", 3, "card_account_number", "client_number",
               "card_product", "credit_balance", "card_currency", "card_status", "business_date"),
    SourceSpec("INVESTMENTS", "investment_accounts", 4, "investment_id", "investor_id",
               "investment_product", "market_value", "investment_currency", "investment_status",
               "valuation_date"),
    SourceSpec("MORTGAGE", "mortgage_accounts", 5, "mortgage_number", "client_code",
               "mortgage_type", "balance_amount", "currency_code", "status", "effective_date"),
    SourceSpec("MOBILE", "mobile_wallet", 6, "wallet_id", "customer_number",
               "wallet_product", "wallet_balance", "wallet_currency", "wallet_status", "load_date"),
    SourceSpec("FOREX", "forex_accounts", 7, "trade_id", "customer_id",
               "forex_product", "trade_amount", "trade_currency", "trade_status", "trade_date"),
)

# Sources that feed the customer master on the first pass.
FIRST_PASS_SOURCES: tuple[str, ...] = ("CORE_BANKING", "LOANS", "INVESTMENTS")

# product_code, product_description, product_category, regulatory_category, product_status
PRODUCTS: tuple[tuple[str, str, str, str, str], ...] = (
    ("SAV001", "Savings Account", "Deposit", "Retail", "ACTIVE"),
    ("CUR001", "Current Account", "Deposit", "Retail", "ACTIVE"),
    ("HOME_LOAN", "Residential Mortgage Loan", "Loans", "Credit", "ACTIVE"),
    ("PERSONAL_LOAN", "Personal Lending Product", "Loans", "Credit", "ACTIVE"),
    ("GOLD_CARD", "Premium Credit Card", "Cards", "Credit", "ACTIVE"),
    ("STANDARD_CARD", "Standard Credit Card", "Cards", "Credit", "ACTIVE"),
    ("EQUITY_FUND", "Equity Investment Fund", "Investments", "Investment", "ACTIVE"),
    ("BOND_FUND", "Fixed Income Investment Fund", "Investments", "Investment", "ACTIVE"),
    ("MOBILE_WALLET", "Digital Wallet", "Digital", "Payment", "ACTIVE"),
    ("FX_FORWARD", "Foreign Exchange Forward", "Forex", "Treasury", "ACTIVE"),
)

PRODUCT_EFFECTIVE_DATE = "2026-01-01"

# currency_code, exchange_rate (to USD), effective for FX_EFFECTIVE_DATE
FX_EFFECTIVE_DATE = "2026-01-31"
FX_RATES: tuple[tuple[str, str], ...] = (
    ("USD", "1.00000000"),
    ("EUR", "1.08000000"),
    ("GBP", "1.25000000"),
    ("ZAR", "0.05500000"),
    ("JPY", "0.00670000"),
)

RULES: tuple[RuleSpec, ...] = (
    RuleSpec("DQ001", "Customer Validation", "HIGH", "Customer Operations"),
    RuleSpec("DQ002", "Product Validation", "MEDIUM", "Product Management"),
    RuleSpec("DQ003", "Currency Validation", "HIGH", "Finance"),
    RuleSpec("DQ004", "Financial Validation", "CRITICAL", "Risk"),
    RuleSpec("DQ005", "Business Rule", "HIGH", "Operations"),
    RuleSpec("DQ006", "Duplicate Account", "CRITICAL", "Data Governance"),
)

# Rule descriptions written into each exception row.
RULE_DESCRIPTIONS: dict[str, str] = {
    "DQ001": "Customer not found in Customer Master",
    "DQ002": "Unknown Product",
    "DQ003": "Exchange Rate Missing",
    "DQ004": "Negative Portfolio Balance",
    "DQ005": "Closed Account Eligible For Reporting",
    "DQ006": "Duplicate Source Account",
}

# exception_category, description, default_severity, business_area
EXCEPTION_CATEGORIES: tuple[tuple[str, str, str, str], ...] = (
    ("Customer Validation", "Customer master validation", "HIGH", "Customer Operations"),
    ("Product Validation", "Product reference validation", "MEDIUM", "Product Management"),
    ("Currency Validation", "Exchange rate validation", "HIGH", "Finance"),
    ("Financial Validation", "Portfolio financial checks", "CRITICAL", "Risk"),
    ("Business Rule", "Business processing rules", "HIGH", "Operations"),
    ("Duplicate Account", "Duplicate portfolio account detection", "CRITICAL", "Data Governance"),
)

# severity_code, priority_level, sla_hours, escalation_required
SEVERITIES: tuple[tuple[str, int, int, bool], ...] = (
    ("CRITICAL", 1, 2, True),
    ("HIGH", 2, 8, True),
    ("MEDIUM", 3, 24, False),
    ("LOW", 4, 72, False),
)

# business_area, business_owner, support_team
OWNERS: tuple[tuple[str, str, str], ...] = (
    ("Customer Operations", "Customer Services Team", "CRM Support"),
    ("Product Management", "Product Owners", "Product Support"),
    ("Finance", "Finance Control", "Finance Operations"),
    ("Risk", "Risk Management", "Risk Analytics"),
    ("Operations", "Operations Team", "Operations Support"),
    ("Data Governance", "Data Quality Office", "Enterprise Data Office"),
)

VALUE_BANDS: tuple[BandSpec, ...] = (
    BandSpec("STANDARD", Decimal("0.00"), Decimal("49999.99")),
    BandSpec("SILVER", Decimal("50000.00"), Decimal("249999.99")),
    BandSpec("GOLD", Decimal("250000.00"), Decimal("999999.99")),
    BandSpec("PLATINUM", Decimal("1000000.00"), Decimal("999999999.99")),
)

THRESHOLDS: tuple[ThresholdSpec, ...] = (
    ThresholdSpec("Exception Rate", Decimal("2.00"), Decimal("5.00"), Decimal("100.00")),
    ThresholdSpec("Critical Exceptions", Decimal("10.00"), Decimal("50.00"), Decimal("100000.00")),
    ThresholdSpec("SLA Failure Rate", Decimal("5.00"), Decimal("15.00"), Decimal("100.00")),
)

# Portfolio health ladder on the exception rate (upper bounds, exclusive).
HEALTH_LADDER: tuple[tuple[Decimal, str], ...] = (
    (Decimal("1"), "EXCELLENT"),
    (Decimal("3"), "GOOD"),
    (Decimal("5"), "FAIR"),
)
HEALTH_OTHERWISE = "POOR"

# Executive status: (severity, more-than count, status)
EXECUTIVE_STATUS: tuple[tuple[str, int, str], ...] = (
    ("CRITICAL", 50, "Immediate Attention"),
    ("HIGH", 200, "Management Review"),
)
EXECUTIVE_OTHERWISE = "Normal Operations"

# Texts and states written into customer exceptions.
SEVERITY_TEXT = "Severity: "
CRITICAL_TEXT = "[CRITICAL] "
EXCEPTION_STATUS = "OPEN"
RESOLUTION_STATUS = "PENDING"

ESCALATION_QUEUES: tuple[tuple[str, str], ...] = (
    ("CRITICAL", "Immediate Response"),
    ("HIGH", "Priority Queue"),
    ("MEDIUM", "Standard Queue"),
)
ESCALATION_QUEUE_OTHERWISE = "Low Priority Queue"

ESCALATION_LEVELS: tuple[tuple[str, int], ...] = (("CRITICAL", 1), ("HIGH", 2), ("MEDIUM", 3))
ESCALATION_LEVEL_OTHERWISE = 4

HIGH_VALUE_MINIMUM = Decimal("500000")
NEGATIVE_PORTFOLIO_LIMIT = Decimal("-10000")
BASE_CURRENCY = "USD"

# Defaults for customers created from account feeds.
MASTER_DEFAULTS = {
    "first_name": "Customer",
    "customer_category": "STANDARD",
    "branch_code": "BR001",
    "customer_status": "ACTIVE",
}

# Defaults for issues whose category is not configured.
UNCLASSIFIED_DEFAULTS = {
    "severity_code": "MEDIUM",
    "severity_description": "Medium Priority",
    "escalation_required": False,
    "resolution_target_hours": 48,
    "business_area": "Data Governance",
    "business_owner": "Data Steward",
    "support_team": "Data Quality Team",
}

# Error categories and texts of the portfolio load.
ERR_MISSING_CUSTOMER = ("MISSING_CUSTOMER", "Customer identifier is missing.")
ERR_MISSING_PRODUCT = ("MISSING_PRODUCT", "Product code is missing.")
ERR_INVALID_BALANCE = ("INVALID_BALANCE", "Account balance is NULL.")
ERR_MISSING_FX = ("MISSING_EXCHANGE_RATE", "Exchange rate not found for currency ")
ERR_UNKNOWN_PRODUCT = ("UNKNOWN_PRODUCT", "Unknown Product Code: ")
ERR_CUSTOMER_NOT_FOUND = ("CUSTOMER_NOT_FOUND", "Customer not found in Customer Master.")
ERR_NEGATIVE_PORTFOLIO = ("NEGATIVE_PORTFOLIO", "Portfolio balance below acceptable threshold.")
ERR_MISSING_CUSTOMER_ID = ("MISSING_CUSTOMER_ID", "Customer identifier is missing or invalid.")

# Lines of an export that cannot be read (category, text before a whole line, text before the fields).
ERR_UNREADABLE_LINE = ("Unreadable Line", "Line with another number of fields: ", "Values of another type: ")
