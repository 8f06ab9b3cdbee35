"""Company-list CSV scan (``company_name, symbol``, header row)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.schemas import COMPANY_LIST


def read_company_list(spark: SparkSession, path: str, with_position: bool = False) -> DataFrame:
    """The header row is skipped, columns are taken by position against the
    fixed schema (a header ``name,symbol`` still loads).  ``position`` (when
    asked) follows file order within each split."""
    df = spark.read.option("header", "true").option("mode", "PERMISSIVE").schema(COMPANY_LIST).csv(path)
    if with_position:
        df = df.withColumn("position", F.monotonically_increasing_id())
    return df


def write_company_list(df: DataFrame, path: str) -> None:
    df.select("company_name", "symbol").write.mode("overwrite").option("header", "true").csv(path)
