"""Spark session helpers.

The library never creates its own session inside an operator: every function
takes DataFrames.  This module is for entry points, tests and the benchmark.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job of this library wants.  They only steer planning; none
# of them changes a result.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Skewed keys (one customer or account holding a large share of rows):
    # let AQE split oversized shuffle partitions of the streamed side.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "ledgerlens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("LEDGERLENS_DRIVER_MEMORY", "8g"))
    extra = dict(extra or {})
    if (master or "").startswith("local") and "spark.checkpoint.dir" not in extra:
        # local runs and tests only: a scratch folder stands in for the shared
        # checkpoint storage a cluster names in spark.checkpoint.dir
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="ledgerlens-ckpt-", dir="/tmp")
    for k, v in extra.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster the operator of the job sets it to shared storage and this
    function only reads it.  Where it is unset (local runs, tests) a fresh
    scratch folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name shared storage on a cluster")
    path = tempfile.mkdtemp(prefix="ledgerlens-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return path
