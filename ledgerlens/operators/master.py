"""Customer master (M1-M2): survivorship across sources and key rejection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import specs
from ..functions.expressions import blank_to_null, date_value, timestamp_value

MASTER_COLUMNS = (
    "customer_id", "first_name", "last_name", "customer_category", "branch_code",
    "customer_status", "created_date", "last_updated_date", "primary_source_system_code",
)


def cleanse_ids(ids: DataFrame) -> DataFrame:
    return ids.withColumn("customer_id", blank_to_null("customer_id"))


def reject_missing_keys(ids: DataFrame, business_date, as_of, execution_id: str | None = None) -> DataFrame:
    """M2: one data-quality issue per source row without a customer id."""
    cat, text = specs.ERR_MISSING_CUSTOMER_ID
    return cleanse_ids(ids).filter(F.col("customer_id").isNull()).select(
        date_value(business_date).alias("business_date"),
        F.col("source_system_code").alias("source_system"),
        F.lit(None).cast("string").alias("customer_id"),
        F.lit(cat).alias("error_category"),
        F.lit(text).alias("error_description"),
        timestamp_value(as_of).alias("logged_date"),
        F.lit(execution_id).cast("string").alias("execution_id"),
    )


def survivors(ids: DataFrame) -> DataFrame:
    """One row per customer, from the highest-priority source.

    ``row_number() = 1`` lets Spark insert a partial WindowGroupLimit before the
    shuffle, so every map task forwards at most one row per customer: a
    customer present in a huge number of source rows costs nothing extra."""
    valid = cleanse_ids(ids).filter(F.col("customer_id").isNotNull())
    w = Window.partitionBy("customer_id").orderBy(F.col("source_priority"), F.col("source_system_code"))
    return (valid.withColumn("_rn", F.row_number().over(w))
                 .filter(F.col("_rn") == 1)
                 .select("customer_id", "source_system_code"))


def build_customer_master(ids: DataFrame, as_of, defaults: Mapping[str, str] = specs.MASTER_DEFAULTS) -> DataFrame:
    """M1: survivors + default attributes + provenance column."""
    ts = timestamp_value(as_of)
    return survivors(ids).select(
        "customer_id",
        F.lit(defaults["first_name"]).alias("first_name"),
        F.col("customer_id").alias("last_name"),
        F.lit(defaults["customer_category"]).alias("customer_category"),
        F.lit(defaults["branch_code"]).alias("branch_code"),
        F.lit(defaults["customer_status"]).alias("customer_status"),
        ts.alias("created_date"),
        ts.alias("last_updated_date"),
        F.col("source_system_code").alias("primary_source_system_code"),
    )


def dedupe_counts(ids: DataFrame) -> DataFrame:
    """Valid rows, rejected rows and duplicates removed, in one aggregate
    (the distinct count is planned as a partial aggregate per customer, so a
    customer with many rows is combined map-side)."""
    c = cleanse_ids(ids)
    return c.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(F.col("customer_id").isNull()).alias("rows_rejected"),
        (F.count(F.col("customer_id")) - F.count_distinct(F.col("customer_id"))).alias("duplicates_removed"),
        F.count_distinct(F.col("customer_id")).alias("customers"),
    )
