"""Golden fixture rows of the source system (business date 2026-01-31).

FIXED VALUES: the 29 sample account rows, the seed customer master and the
golden outputs (portfolio totals, exception hashes, scorecard) that the
source system published; tests compare our results with them.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerlens import specs

BD = dt.date(2026, 1, 31)
LOGGED = dt.datetime(2026, 8, 10, 18, 50, 43)
CAPTURED = dt.datetime(2026, 8, 11, 14, 30, 44)

# source table -> rows (account, customer, product, balance, currency, status)
ACCOUNTS: dict[str, list[tuple]] = {
    "core_banking_accounts": [
        ("CB10001", "CUST001", "SAV001", "25000.00", "USD", "ACTIVE"),
        ("CB10002", "CUST002", "CUR001", "75000.00", "EUR", "ACTIVE"),
        ("CB10003", "CUST003", "SAV001", "0.00", "USD", "ACTIVE"),
        ("CB10004", "CUST004", "CUR001", "-5000.00", "GBP", "ACTIVE"),
        ("CB10005", None, "SAV001", "10000.00", "USD", "ACTIVE"),
        ("CB10006", "CUST006", None, "15000.00", "USD", "ACTIVE"),
        ("CB10007", "CUST007", "SAV001", "45000.00", None, "ACTIVE"),
        ("CB10008", "CUST008", "SAV001", "8000.00", "USD", "CLOSED"),
    ],
    "loan_accounts": [
        ("LN10001", "CUST001", "HOME_LOAN", "500000", "USD", "ACTIVE"),
        ("LN10002", "CUST002", "PERSONAL_LOAN", "25000", "EUR", "ACTIVE"),
        ("LN10003", "CUST009", "HOME_LOAN", "750000", "GBP", "ACTIVE"),
        ("LN10004", "CUST010", "PERSONAL_LOAN", "-1000", "USD", "ACTIVE"),
        ("LN10005", "CUST011", "UNKNOWN", "30000", "USD", "ACTIVE"),
    ],
    "card_accounts": [
        ("CARD001", "CUST001", "GOLD_CARD", "12000", "USD", "ACTIVE"),
        ("CARD002", "CUST003", "STANDARD_CARD", "5000", "USD", "ACTIVE"),
        ("CARD003", "CUST004", "GOLD_CARD", "25000", "EUR", "ACTIVE"),
        ("CARD004", "CUST005", "STANDARD_CARD", None, "USD", "ACTIVE"),
    ],
    "investment_accounts": [
        ("INV001", "CUST001", "EQUITY_FUND", "150000", "USD", "ACTIVE"),
        ("INV002", "CUST012", "BOND_FUND", "250000", "EUR", "ACTIVE"),
        ("INV003", "CUST013", "EQUITY_FUND", "1000000", "USD", "ACTIVE"),
    ],
    "mortgage_accounts": [
        ("MORT001", "CUST001", "HOME", "900000", "USD", "ACTIVE"),
        ("MORT002", "CUST014", "HOME", "1200000", "USD", "ACTIVE"),
        ("MORT003", "CUST015", "HOME", "500000", "GBP", "CLOSED"),
    ],
    "mobile_wallet": [
        ("WAL001", "CUST001", "MOBILE_WALLET", "500", "USD", "ACTIVE"),
        ("WAL002", "CUST020", "MOBILE_WALLET", "1000", "EUR", "ACTIVE"),
        ("WAL003", "CUST021", "MOBILE_WALLET", "0", "USD", "ACTIVE"),
    ],
    "forex_accounts": [
        ("FX001", "CUST001", "FX_FORWARD", "250000", "USD", "ACTIVE"),
        ("FX002", "CUST030", "FX_SWAP", "500000", "EUR", "ACTIVE"),
        ("FX003", "CUST031", "FX_FORWARD", "-50000", "GBP", "ACTIVE"),
    ],
}

# customer_id, first_name, last_name, customer_category, branch_code
SEED9 = [
    ("CUST001", "John", "Smith", "PREMIUM", "BR001"),
    ("CUST002", "Mary", "Jones", "STANDARD", "BR002"),
    ("CUST003", "Peter", "Brown", "STANDARD", "BR001"),
    ("CUST004", "Sarah", "Williams", "PREMIUM", "BR003"),
    ("CUST006", "David", "Miller", "BUSINESS", "BR004"),
    ("CUST007", "James", "Wilson", "STANDARD", "BR002"),
    ("CUST008", "Linda", "Taylor", "STANDARD", "BR001"),
    ("CUST010", "Robert", "Johnson", "BUSINESS", "BR005"),
    ("CUST012", "Michael", "Davis", "PREMIUM", "BR006"),
]

# Golden exceptions: (account, customer, rule, value, hash)
GOLDEN_EXCEPTIONS = [
    ("CB10004", "CUST004", "DQ004", "-6250.00", "F8033407F2DDF244E88392CCB150A03BF3E96598A0016BDBD968CF1818BD5EC7"),
    ("CARD004", "CUST005", "DQ001", "CUST005", "F1771CCC7C1F8D446A9B8495B2FAEB678444804A51C5D150C591F6F44F7FC45E"),
    ("LN10003", "CUST009", "DQ001", "CUST009", "2597B1A9FB0DCBFFDFF00110DC4F3C007476431B6225DB515CC032F5C7029786"),
    ("LN10004", "CUST010", "DQ004", "-1000.00", "E8235FC8E2C4979D13260730C4D1DD55F1A880C203265189ED4C95F0EDDEBDD7"),
    ("INV003", "CUST013", "DQ001", "CUST013", "647945AEA382AF56A5CEDECA248996FAA6DB03DB46F46BD681BB953DA53CCF15"),
    ("WAL002", "CUST020", "DQ001", "CUST020", "D440B300A65FC018368301AC9FA0ED53C7A18DBF2D611EB57536FDC8B23A3F2C"),
    ("FX003", "CUST031", "DQ001", "CUST031", "7B40089B3810FE8715BEF1D1CC577202FAF84DC5E83A41E8B239A59FECF175CE"),
    ("FX003", "CUST031", "DQ004", "-62500.00", "E501BC538AE30C44BD4E2B309B42CF2FBC551F869E7929B26AE3E2195F56B36A"),
]

GOLDEN_SCORECARD = {
    "Portfolio Health": ("POOR", "RED"),
    "Critical Exceptions": ("3", "GREEN"),
    "Exception Rate": ("42.11", "RED"),
    "SLA Compliance": ("0.000000", "RED"),
}

MASTER_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("customer_category", T.StringType()),
    T.StructField("branch_code", T.StringType()),
    T.StructField("customer_status", T.StringType()),
    T.StructField("created_date", T.TimestampNTZType()),
    T.StructField("last_updated_date", T.TimestampNTZType()),
    T.StructField("primary_source_system_code", T.StringType()),
])


def source_tables(spark: SparkSession, date: dt.date = BD) -> dict[str, DataFrame]:
    out = {}
    by_table = {s.table: s for s in specs.SOURCES}
    for table, rows in ACCOUNTS.items():
        s = by_table[table]
        schema = T.StructType([
            T.StructField(s.account, T.StringType(), False),
            T.StructField(s.customer, T.StringType()),
            T.StructField(s.product, T.StringType()),
            T.StructField(s.balance, T.DecimalType(18, 2)),
            T.StructField(s.currency, T.StringType()),
            T.StructField(s.status, T.StringType()),
            T.StructField(s.date, T.DateType()),
        ])
        data = [(a, c, p, None if b is None else Decimal(b), cur, st, date) for a, c, p, b, cur, st in rows]
        out[table] = spark.createDataFrame(data, schema)
    return out


def master(spark: SparkSession, rows=SEED9, created: dt.datetime = dt.datetime(2026, 8, 8, 8, 30, 14)) -> DataFrame:
    return spark.createDataFrame(
        [(c, f, l, cat, br, "ACTIVE", created, None, None) for c, f, l, cat, br in rows], MASTER_SCHEMA)


def default_master(spark: SparkSession, ids: list[str]) -> DataFrame:
    return master(spark, [(c, "Customer", c, "STANDARD", "BR001") for c in ids])
