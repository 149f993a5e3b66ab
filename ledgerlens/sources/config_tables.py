"""Configuration and reference tables as DataFrames.

All of these are bounded by the number of configuration rows (tens), so they
are safe to broadcast; callers may pass their own DataFrames read from the
config schema instead.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import specs


def _date(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


PRODUCT_SCHEMA = T.StructType([
    T.StructField("product_code", T.StringType()),
    T.StructField("product_description", T.StringType()),
    T.StructField("product_category", T.StringType()),
    T.StructField("regulatory_category", T.StringType()),
    T.StructField("product_status", T.StringType()),
    T.StructField("effective_date", T.DateType()),
])

FX_SCHEMA = T.StructType([
    T.StructField("currency_code", T.StringType()),
    T.StructField("exchange_rate", T.DecimalType(18, 8)),
    T.StructField("effective_date", T.DateType()),
])

RULE_SCHEMA = T.StructType([
    T.StructField("rule_code", T.StringType()),
    T.StructField("exception_category", T.StringType()),
    T.StructField("severity_code", T.StringType()),
    T.StructField("business_area", T.StringType()),
    T.StructField("rule_enabled", T.BooleanType()),
])

CATEGORY_SCHEMA = T.StructType([
    T.StructField("exception_category", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("default_severity", T.StringType()),
    T.StructField("business_area", T.StringType()),
])

SEVERITY_SCHEMA = T.StructType([
    T.StructField("severity_code", T.StringType()),
    T.StructField("priority_level", T.IntegerType()),
    T.StructField("sla_hours", T.IntegerType()),
    T.StructField("escalation_required", T.BooleanType()),
])

OWNER_SCHEMA = T.StructType([
    T.StructField("business_area", T.StringType()),
    T.StructField("business_owner", T.StringType()),
    T.StructField("support_team", T.StringType()),
])

SOURCE_CONFIG_SCHEMA = T.StructType([
    T.StructField("source_system_code", T.StringType()),
    T.StructField("product_table", T.StringType()),
    T.StructField("load_priority", T.IntegerType()),
    T.StructField("source_account_field", T.StringType()),
    T.StructField("customer_field", T.StringType()),
    T.StructField("product_field", T.StringType()),
    T.StructField("balance_field", T.StringType()),
    T.StructField("currency_field", T.StringType()),
    T.StructField("status_field", T.StringType()),
    T.StructField("business_date_field", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("supports_incremental", T.BooleanType()),
])

BAND_SCHEMA = T.StructType([
    T.StructField("band_name", T.StringType()),
    T.StructField("minimum_value", T.DecimalType(18, 2)),
    T.StructField("maximum_value", T.DecimalType(18, 2)),
])

THRESHOLD_SCHEMA = T.StructType([
    T.StructField("metric_name", T.StringType()),
    T.StructField("green_threshold", T.DecimalType(18, 2)),
    T.StructField("amber_threshold", T.DecimalType(18, 2)),
    T.StructField("red_threshold", T.DecimalType(18, 2)),
])


def products(spark: SparkSession) -> DataFrame:
    eff = _date(specs.PRODUCT_EFFECTIVE_DATE)
    return spark.createDataFrame([(*p, eff) for p in specs.PRODUCTS], PRODUCT_SCHEMA)


def exchange_rates(spark: SparkSession) -> DataFrame:
    eff = _date(specs.FX_EFFECTIVE_DATE)
    return spark.createDataFrame([(c, Decimal(r), eff) for c, r in specs.FX_RATES], FX_SCHEMA)


def exception_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(r.code, r.category, r.severity, r.area, r.enabled) for r in specs.RULES], RULE_SCHEMA)


def exception_categories(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(specs.EXCEPTION_CATEGORIES), CATEGORY_SCHEMA)


def exception_severities(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(specs.SEVERITIES), SEVERITY_SCHEMA)


def business_owners(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(specs.OWNERS), OWNER_SCHEMA)


def source_configuration(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(s.code, s.table, s.priority, s.account, s.customer, s.product, s.balance, s.currency,
          s.status, s.date, s.active, s.supports_incremental) for s in specs.SOURCES],
        SOURCE_CONFIG_SCHEMA)


def value_bands(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(b.name, b.minimum, b.maximum) for b in specs.VALUE_BANDS], BAND_SCHEMA)


def reporting_thresholds(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(t.metric, t.green, t.amber, t.red) for t in specs.THRESHOLDS], THRESHOLD_SCHEMA)


def source_specs_from_config(config: DataFrame) -> list[specs.SourceSpec]:
    """Collect the (bounded: one row per source system) mapping table into specs.

    This is the only collect of the extraction path: the control plane, a
    handful of rows, never account data.
    """
    rows = config.orderBy("load_priority", "source_system_code").collect()
    return [specs.SourceSpec(
        code=r.source_system_code, table=r.product_table, priority=r.load_priority,
        account=r.source_account_field, customer=r.customer_field, product=r.product_field,
        balance=r.balance_field, currency=r.currency_field, status=r.status_field,
        date=r.business_date_field, active=r.is_active,
        supports_incremental=r.supports_incremental) for r in rows]


def bands_from_config(bands: DataFrame) -> list[specs.BandSpec]:
    """The band rows (bounded: one per value band) as specs."""
    return [specs.BandSpec(r.band_name, r.minimum_value, r.maximum_value)
            for r in bands.orderBy("minimum_value").collect()]


def thresholds_from_config(thresholds: DataFrame) -> list[specs.ThresholdSpec]:
    """The reporting thresholds (bounded: one row per metric) as specs."""
    return [specs.ThresholdSpec(r.metric_name, r.green_threshold, r.amber_threshold, r.red_threshold)
            for r in thresholds.orderBy("metric_name").collect()]
