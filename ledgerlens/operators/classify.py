"""Customer-master exceptions (E1-E4): dedupe, classify, escalate, summarise."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import specs
from ..functions.expressions import add_hours, date_value, lookup_expr, timestamp_value

EXCEPTION_COLUMNS = (
    "business_date", "customer_id", "source_system_code", "exception_category",
    "exception_description", "severity_code", "severity_description", "escalation_required",
    "resolution_target_hours", "business_area", "business_owner", "support_team", "logged_date",
    "exception_status", "assigned_date", "resolution_status", "escalation_level",
    "resolution_due_date",
)


def dedupe_issues(issues: DataFrame) -> DataFrame:
    """Newest issue per (customer, category, description).

    NULL customers group together, so all missing-id issues with one text
    collapse to one row.  Ties on ``logged_date`` are broken by source and
    execution id so the survivor is deterministic (D14)."""
    w = Window.partitionBy("customer_id", "error_category", "error_description").orderBy(
        F.col("logged_date").desc(), F.col("source_system").asc_nulls_last(),
        F.col("execution_id").asc_nulls_last())
    return issues.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def classify_issues(issues: DataFrame, categories: DataFrame, severities: DataFrame,
                    owners: DataFrame, business_date, as_of,
                    defaults: Mapping[str, object] = specs.UNCLASSIFIED_DEFAULTS) -> DataFrame:
    """Configured categories take their severity, SLA and owner; the rest get defaults.

    One left join to the (broadcast) category x severity table replaces the
    classified/unclassified pair.  A category whose severity is not configured
    is dropped (the inner join of the classified path), neither classified
    nor defaulted."""
    cat_sev = (categories.join(F.broadcast(severities),
                               categories["default_severity"] == severities["severity_code"], "left")
               .select(F.col("exception_category").alias("_cat"),
                       F.col("business_area").alias("_area"),
                       F.col("severity_code").alias("_sev"),
                       F.col("escalation_required").alias("_esc"),
                       F.col("sla_hours").alias("_sla")))
    own = owners.select(F.col("business_area").alias("_own_area"),
                        F.col("business_owner").alias("_owner"), F.col("support_team").alias("_team"))
    j = (issues.join(F.broadcast(cat_sev), F.col("error_category") == F.col("_cat"), "left")
               .join(F.broadcast(own), F.col("_area") == F.col("_own_area"), "left"))
    classified = F.col("_cat").isNotNull()
    # configured category without a configured severity: dropped
    j = j.filter(~classified | F.col("_sev").isNotNull())

    def pick(cfg, default):
        return F.when(classified, cfg).otherwise(F.lit(default))

    return j.select(
        F.col("customer_id"),
        F.col("source_system").alias("source_system_code"),
        F.col("error_category").alias("exception_category"),
        F.col("error_description").alias("exception_description"),
        pick(F.col("_sev"), defaults["severity_code"]).alias("severity_code"),
        F.when(classified, F.concat(F.lit(specs.SEVERITY_TEXT), F.col("_sev")))
         .otherwise(F.lit(defaults["severity_description"])).alias("severity_description"),
        pick(F.col("_esc"), defaults["escalation_required"]).alias("escalation_required"),
        pick(F.col("_sla"), defaults["resolution_target_hours"]).cast("int").alias("resolution_target_hours"),
        pick(F.col("_area"), defaults["business_area"]).alias("business_area"),
        pick(F.col("_owner"), defaults["business_owner"]).alias("business_owner"),
        pick(F.col("_team"), defaults["support_team"]).alias("support_team"),
        F.col("logged_date"),
        date_value(business_date).alias("business_date"),
        F.lit(specs.EXCEPTION_STATUS).alias("exception_status"),
        timestamp_value(as_of).alias("assigned_date"),
        F.lit(specs.RESOLUTION_STATUS).alias("resolution_status"),
    )


def escalate(exceptions: DataFrame) -> DataFrame:
    """Escalation level 1-4, due date = logged + target hours, [CRITICAL] prefix."""
    crit = F.col("severity_code") == "CRITICAL"
    return exceptions.withColumns({
        "escalation_level": lookup_expr("severity_code", specs.ESCALATION_LEVELS,
                                        specs.ESCALATION_LEVEL_OTHERWISE),
        "resolution_due_date": add_hours("logged_date", "resolution_target_hours"),
        "exception_description": F.when(crit, F.concat(F.lit(specs.CRITICAL_TEXT), F.col("exception_description")))
                                  .otherwise(F.col("exception_description")),
    })


def customer_exceptions(issues: DataFrame, categories: DataFrame, severities: DataFrame,
                        owners: DataFrame, business_date, as_of) -> DataFrame:
    """E1 -> E2 -> E3."""
    return escalate(classify_issues(dedupe_issues(issues), categories, severities, owners,
                                    business_date, as_of)).select(*EXCEPTION_COLUMNS)


def severity_summary(exceptions: DataFrame, group_by: tuple[str, ...] = ("business_date",)) -> DataFrame:
    """Totals per severity; ``count_if`` gives 0, not NULL, on no rows."""
    sev = F.col("severity_code")
    return exceptions.groupBy(*group_by).agg(
        F.count(F.lit(1)).alias("total_exceptions"),
        F.count_if(sev == "CRITICAL").alias("critical_exceptions"),
        F.count_if(sev == "HIGH").alias("high_exceptions"),
        F.count_if(sev == "MEDIUM").alias("medium_exceptions"),
        F.count_if(sev == "LOW").alias("low_exceptions"),
        F.count_if(F.col("escalation_required")).alias("escalated_exceptions"),
    )


def daily_by_severity(exceptions: DataFrame) -> DataFrame:
    """Exceptions per (date, severity)."""
    return exceptions.groupBy("business_date", "severity_code").agg(
        F.count(F.lit(1)).alias("exception_count"))


def daily_by_area(exceptions: DataFrame) -> DataFrame:
    """Exceptions and escalations per (date, business area)."""
    return exceptions.groupBy("business_date", "business_area").agg(
        F.count(F.lit(1)).alias("exception_count"),
        F.count_if(F.col("escalation_required")).alias("escalated_count"))
