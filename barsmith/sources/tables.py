"""Scans of the parquet tables in a data folder."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-spread a scan that yields fewer partitions than the cluster has
    cores (a small file, or one written as a single row group), so the per-row
    work before the first shuffle is not done by one task.  A large scan
    already has thousands of splits and is returned untouched."""
    try:
        cores = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # Spark Connect has no client-side RDD API: leave the scan as it is
        return df
    if splits >= cores:
        return df
    return df.repartition(cores, *keys)
