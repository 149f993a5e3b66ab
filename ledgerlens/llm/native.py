"""Column helpers shared by the operators that run on built-in functions only."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerlens.session import ensure_checkpoint_dir


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared checkpoint folder: later reads neither
    repeat its work nor depend on an executor, and joins know its size."""
    spark = frame.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of at most ``rows`` rows between Spark and its Python workers for
    what is written inside, so that very long texts fit a worker."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(rows))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def row_key(text: Column) -> Column:
    """Together with doc_id the identity of a row's content: rows that agree in
    both give equal results, so repeated rows need no key of their own."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)
