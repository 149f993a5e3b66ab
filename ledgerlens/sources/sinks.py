"""Sinks and snapshot helpers.

Plain Parquet: append with ``business_date`` partitions, dynamic overwrite of
the touched dates, full overwrite, or write-new-then-switch for upserts.  All
paths are expected on shared storage (never a machine-local folder on a
cluster).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import specs
from ..functions.expressions import date_value, timestamp_value
from .tables import VersionedTable


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ("business_date",)) -> None:
    """Append, partitioned by business date."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Truncate and reload."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite_dates(df: DataFrame, path: str, partition_by: Sequence[str] = ("business_date",)) -> None:
    """Dynamic partition overwrite: replaces only the dates present in ``df``.

    A date whose new row set is empty is untouched; use
    ``upsert.replace_date`` + ``write_then_switch`` for that case."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by).parquet(path))


_WHOLE = "table"


def write_then_switch(df: DataFrame, base: str, version: str,
                      partition_by: Sequence[str] = ()) -> str:
    """Write a new version of a whole table under ``base/version``, make it
    current and return its path.

    Readers keep using the previous version until the switch, which is one
    rename that fails if another load switched meanwhile (``tables.commit``)."""
    table = VersionedTable(df.sparkSession, base)
    before = table.current()
    path = f"{table.base}/{version}"
    overwrite(df, path, partition_by)
    # a whole table may change its columns, so no schema is held against it
    table.commit(before, {_WHOLE: version}, "")
    return path


def current_version(spark: SparkSession, base: str) -> str | None:
    """Path of the table's current version, None before the first load."""
    table = VersionedTable(spark, base)
    now = table.current()
    return None if now is None else f"{table.base}/{now.parts[_WHOLE]}"


def snapshot(df: DataFrame, path: str, captured_at) -> None:
    """Freeze an output as a baseline, stamped with the capture time."""
    overwrite(df.withColumn("baseline_capture_date", timestamp_value(captured_at)), path)


def table_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count, as one union of aggregates."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


_LINE = "line_as_read"


def _csv_lines(spark: SparkSession, path: str, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Every line of a headerless export: its fields as text and their typed
    values, and the line itself where its fields cannot be told apart."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n, _ in columns]
                          + [T.StructField(_LINE, T.StringType())])
    raw = (spark.read.schema(schema).option("header", "false").option("nullValue", "NULL")
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE)
           .option("encoding", "UTF-8").csv(path))
    first = columns[0][0]
    raw = raw.withColumn(first, F.regexp_replace(F.col(first), "^\ufeff", ""))
    typed = [F.col(n).try_cast(t).alias(f"as_{n}") for n, t in columns]
    return raw.select(*(n for n, _ in columns), _LINE, *typed)


def _unreadable(columns: Sequence[tuple[str, str]]) -> Column:
    """The fields of a line that hold a value which is none of their type."""
    return F.filter(F.array(*(F.when(F.col(n).isNotNull() & F.col(f"as_{n}").isNull(), F.lit(n)) for n, _ in columns)),
                    lambda x: x.isNotNull())


def read_headerless_csv(spark: SparkSession, path: str, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Headerless CSV export (``NULL`` for nulls, UTF-8 BOM tolerated), typed
    by the ``(name, type)`` list.

    Every field is read as text with inference off.  A line with another number
    of fields, or with a value that is none of its type, is left out; see
    ``csv_rejects``."""
    lines = _csv_lines(spark, path, columns)
    good = lines.where(F.col(_LINE).isNull() & (F.size(_unreadable(columns)) == 0))
    return good.select(*(F.col(f"as_{n}").alias(n) for n, _ in columns))


def csv_rejects(spark: SparkSession, path: str, columns: Sequence[tuple[str, str]], source: str, business_date,
                as_of, execution_id: str | None = None) -> DataFrame:
    """A data-quality issue for each line that ``read_headerless_csv`` leaves out."""
    category, malformed, mistyped = specs.ERR_UNREADABLE_LINE
    lines = _csv_lines(spark, path, columns).withColumn("bad", _unreadable(columns))
    wrong = F.transform("bad", lambda name: F.concat(name, F.lit("="), F.element_at(
        F.create_map(*(x for n, _ in columns for x in (F.lit(n), F.col(n)))), name)))
    text = F.when(F.col(_LINE).isNotNull(), F.concat(F.lit(malformed), F.regexp_replace(F.col(_LINE), "^\ufeff", ""))) \
        .otherwise(F.concat(F.lit(mistyped), F.array_join(wrong, ", ")))
    told = lines.where(F.col(_LINE).isNotNull() | (F.size("bad") > 0)).select(text.alias("told"))
    return told.select(
        date_value(business_date).alias("business_date"), F.lit(source).alias("source_system"),
        F.lit(None).cast("string").alias("customer_id"), F.lit(category).alias("error_category"),
        F.col("told").alias("error_description"), timestamp_value(as_of).alias("logged_date"),
        F.lit(execution_id).cast("string").alias("execution_id"))
