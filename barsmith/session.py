"""SparkSession factory.

The master is never hard-coded: a cluster launcher (spark-submit) supplies it.
Only when nothing is configured (a plain ``python`` run, tests) do we fall back
to ``local[*]``.
"""
from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF: dict[str, str] = {
    # Dates come from epoch milliseconds in UTC; every date function must agree.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.hadoop.mapreduce.fileoutputcommitter.marksuccessfuljobs": "false",
    # HotSpot never compiles a method past 8000 bytes: split such a stage rather than run it interpreted
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # no Python call-site capture per column function (plan construction cost)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Sizing for a large cluster (100 TB class inputs).  Shuffles start with many
# partitions that AQE coalesces towards the advisory size, so a partition
# stays a few hundred MB whatever the stage's volume; file splits of 512 MB
# keep the task count of a 100 TB scan near 200k; a partition five times the
# median and above 1 GB counts as skewed and is split at joins.
CLUSTER_CONF: dict[str, str] = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "32000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
}


def get_session(app_name: str = "barsmith", conf: dict[str, str] | None = None,
                profile: str = "local") -> SparkSession:
    """``profile="cluster"`` adds :data:`CLUSTER_CONF` for settings the
    cluster did not set itself; explicit ``conf`` always wins."""
    builder = SparkSession.builder.appName(app_name)
    if profile == "cluster":
        from pyspark import SparkConf

        preset = SparkConf()  # what spark-submit / spark-defaults already set
        conf = {**{k: v for k, v in CLUSTER_CONF.items() if not preset.contains(k)}, **(conf or {})}
    if "MASTER" not in os.environ and "spark.master" not in (conf or {}):
        builder = builder.master(os.environ.get("BARSMITH_MASTER", "local[*]"))
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.master.startswith("local") or spark.conf.get("spark.checkpoint.dir", None):
        ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if the
    cluster named none (local runs and tests)."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no client-side SparkContext
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder") from None
        return configured
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="barsmith-ckpt-")
    sc.setCheckpointDir(local)
    return local
