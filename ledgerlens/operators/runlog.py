"""Run log (L1-L4): append-only events, latest state per run, stage summaries.

A run writes a RUNNING event when a stage starts and a SUCCESS (or FAILED)
event when it ends; the run-log view is the newest event per
(execution, stage), so no row is ever updated in place.  Row counts come
from aggregates of the stage outputs, evaluated together in one job.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import date_value, timestamp_value

EVENT_SCHEMA = T.StructType([
    T.StructField("execution_id", T.StringType()),
    T.StructField("procedure_name", T.StringType()),
    T.StructField("business_date", T.DateType()),
    T.StructField("load_type", T.StringType()),
    T.StructField("event_time", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    T.StructField("rows_read", T.LongType()),
    T.StructField("rows_inserted", T.LongType()),
    T.StructField("rows_updated", T.LongType()),
    T.StructField("rows_rejected", T.LongType()),
    T.StructField("message", T.StringType()),
])

STAGES = ("load_customer_master", "load_customer_exceptions", "load_customer_portfolio",
          "load_portfolio_exceptions", "load_exception_report")


#: Minutes between the planned starts of two stages, and seconds planned for each.
SLOT_MINUTES, SLOT_SECONDS = 10, 300


def stage_events(day) -> DataFrame:
    """RUNNING + SUCCESS events of the five stages of ``day`` (a BankDay), at
    their planned times (a view over lazy frames measures nothing; measured
    times come from ``logged_run``).

    Every frame is counted once: the one-row counts are gathered into one wide
    row, which ``inline`` expands to the ten events."""
    u = day.master_upsert.select("_action")
    counted = {"ids": day.customer_ids, "issues": day.data_quality_issues, "customer_exc": day.customer_exceptions,
               "staged": day.staged, "portfolio": day.portfolio, "errors": day.portfolio_errors,
               "exceptions": day.exceptions, "report": day.scorecard}
    parts = [df.agg(F.count(F.lit(1)).alias(name)) for name, df in counted.items()]
    parts.append(u.agg(F.count_if(F.col("_action") == "INSERT").alias("inserted"),
                       F.count_if(F.col("_action") == "UPDATE").alias("updated")))
    names = (*counted, "inserted", "updated")
    wide = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts).agg(
        *(F.max(n).alias(n) for n in names))
    none = F.lit(None).cast("long")
    zero = F.lit(0).cast("long")
    stages = (
        (STAGES[0], "ids", F.col("inserted"), F.col("updated"), F.col("issues")),
        (STAGES[1], "issues", F.col("customer_exc"), zero, zero),
        (STAGES[2], "staged", F.col("portfolio"), zero, F.col("errors")),
        (STAGES[3], "portfolio", F.col("exceptions"), zero, zero),
        (STAGES[4], "exceptions", F.col("report"), zero, zero),
    )
    start, events = timestamp_value(day.as_of), []

    def event(name: str, at: Column, status: str, counts: tuple, message: str) -> Column:
        return F.struct(F.lit(day.execution_id).cast("string").alias("execution_id"),
                        F.lit(name).alias("procedure_name"), date_value(day.business_date).alias("business_date"),
                        F.lit(day.load_type).alias("load_type"), at.alias("event_time"),
                        F.lit(status).alias("status"),
                        *(c.alias(n) for c, n in zip(counts, ("rows_read", "rows_inserted", "rows_updated",
                                                              "rows_rejected"))),
                        F.lit(message).alias("message"))

    for i, (name, read, inserted, updated, rejected) in enumerate(stages):
        at = i * SLOT_MINUTES * 60
        events.append(event(name, F.timestamp_add("SECOND", F.lit(at), start), "RUNNING", (none,) * 4, "started"))
        events.append(event(name, F.timestamp_add("SECOND", F.lit(at + SLOT_SECONDS), start), "SUCCESS",
                            (F.col(read), inserted, updated, rejected), "completed"))
    return wide.select(F.inline(F.array(*events)))


def _rank(status: Column) -> Column:
    """Of events at one time the one that ends the stage is the newer."""
    return F.when(status == "RUNNING", 0).when(status == "SUCCESS", 1).otherwise(2)


def latest(events: DataFrame) -> DataFrame:
    """L1 view: newest event per (execution, stage) with start time and duration."""
    g = events.groupBy("execution_id", "procedure_name").agg(
        F.max_by(F.struct(*[c for c in events.columns if c not in ("execution_id", "procedure_name")]),
                 F.struct("event_time", _rank(F.col("status")))).alias("last"),
        F.min("event_time").alias("start_time"))
    return g.select("execution_id", "procedure_name", "last.business_date", "last.load_type", "start_time",
                    F.col("last.event_time").alias("end_time"), "last.status", "last.rows_read",
                    "last.rows_inserted", "last.rows_updated", "last.rows_rejected",
                    F.timestamp_diff("SECOND", F.col("start_time"), F.col("last.event_time")).alias("duration_seconds"),
                    "last.message")


def newest_runs(events: DataFrame) -> DataFrame:
    """The run log, newest stage first."""
    return latest(events).orderBy(F.col("start_time").desc(), F.col("end_time").desc(), "execution_id",
                                  "procedure_name")


# --- writing events (L1-L2) ----------------------------------------------------

def event_row(spark: SparkSession, execution_id: str, procedure: str, business_date: dt.date,
              load_type: str, status: str, at: dt.datetime, message: str = "",
              counts: tuple[int | None, int | None, int | None, int | None] = (None, None, None, None)) -> DataFrame:
    return spark.createDataFrame(
        [(execution_id, procedure, business_date, load_type, at, status, *counts, message)], EVENT_SCHEMA)


def events_of(spark: SparkSession, log_path: str) -> DataFrame | None:
    """All events of a run log, None where there is none yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(log_path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema(EVENT_SCHEMA).parquet(log_path)


def finished_stages(spark: SparkSession, log_path: str, execution_id: str | None, business_date: dt.date,
                    clock=dt.datetime.now) -> dict[str, dict]:
    """What the stages of an execution that ended well recorded, by name.  A stage
    still RUNNING belongs to a driver that is gone (an execution has one driver):
    it gets a FAILED event."""
    events = events_of(spark, log_path)
    if events is None:
        return {}
    own = events.where(F.col("execution_id").eqNullSafe(F.lit(execution_id))
                       & (F.col("business_date") == F.lit(business_date)))
    found = {}
    for r in latest(own).collect():  # a row a stage
        if r.status == "RUNNING":
            event_row(spark, execution_id, r.procedure_name, business_date, r.load_type, "FAILED", clock(),
                      "closed by a later run: the driver ended without an event").write.mode("append").parquet(log_path)
        elif r.status == "SUCCESS" and r.message.startswith("completed {"):
            found[r.procedure_name] = json.loads(r.message.removeprefix("completed "))
    return found


@contextlib.contextmanager
def logged_run(spark: SparkSession, log_path: str, execution_id: str, procedure: str,
               business_date: dt.date, load_type: str, clock=dt.datetime.now):
    """Append RUNNING on entry and SUCCESS / FAILED on exit (L2: a failed stage
    never stays RUNNING).  The body may set ``ctx['counts']`` and ``ctx['message']``."""
    ctx: dict = {"counts": (None, None, None, None), "message": "completed"}
    event_row(spark, execution_id, procedure, business_date, load_type, "RUNNING", clock(), "started") \
        .write.mode("append").parquet(log_path)
    try:
        yield ctx
    except Exception as exc:  # noqa: BLE001 - recorded, then re-raised
        event_row(spark, execution_id, procedure, business_date, load_type, "FAILED", clock(),
                  f"{type(exc).__name__}: {exc}").write.mode("append").parquet(log_path)
        raise
    event_row(spark, execution_id, procedure, business_date, load_type, "SUCCESS", clock(),
              ctx["message"], ctx["counts"]).write.mode("append").parquet(log_path)
