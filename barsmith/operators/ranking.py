"""Distributed global ``rank()``, assigned in place.

``rank() OVER (ORDER BY v)`` with no PARTITION BY makes Spark move every row
into a single task.  Here:

1. the scored rows are evaluated once and stored;
2. an order-statistics table, one row with the values at evenly spaced places
   of the order, splits them: a row either equals a split point or lies
   between two neighbours, and the number of that cell orders the cells;
3. the rows of each cell are counted (two cells a split point, so the table
   of the rows before each cell is bounded by the partition count);
4. rows that equal a split point all have the rank behind those counts, and
   rows between two of them are ranked within their cell.

A value that more rows hold than a cell may is a split point itself, so its rows
take part in no window: a value held by a third of all rows costs a lookup
each.  No row is joined with anything on a double.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.session import ensure_checkpoint_dir

MAX_RANGE_PARTITIONS = 1024
#: the split points' places are off by one in so many rows at most
ACCURACY = 10_000


def global_rank(
    df: DataFrame,
    value: str,
    rank_name: str = "rank",
    descending: bool = True,
    num_partitions: int | None = None,
) -> DataFrame:
    """``df`` plus ``rank_name`` = ``rank() OVER (ORDER BY value [DESC])`` as int.

    NULL values rank last (Spark's default for DESC and ASC NULLS LAST); NaN is
    the greatest number."""
    spark = df.sparkSession
    # only the number of cells is bounded, never the data
    parts = num_partitions or min(int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_RANGE_PARTITIONS)
    ensure_checkpoint_dir(spark)
    scored = df.checkpoint()
    v = F.col(value)
    number = v.isNotNull() & ~F.isnan(v.cast("double"))
    places = [i / parts for i in range(parts + 1)]
    # one row, at most a value a cell and one more
    row = scored.where(number).agg(F.percentile_approx(value, places, ACCURACY)).first()
    splits = F.lit(sorted(set(row[0]))).cast(T.ArrayType(df.schema[value].dataType)) if row[0] else F.array().cast(T.ArrayType(df.schema[value].dataType))
    better = (lambda s: s > v) if descending else (lambda s: s < v)
    # even cells lie between two split points, odd ones hold one value: a split point, NaN or NULL
    nan, null = (F.lit(-1), F.lit(2 * parts + 5)) if descending else (F.lit(2 * parts + 3), F.lit(2 * parts + 5))
    cell = (F.when(v.isNull(), null).when(F.isnan(v.cast("double")), nan)
            .otherwise(2 * F.size(F.filter(splits, better)) + F.array_contains(splits, v).cast("int")))
    placed = scored.withColumn("_cell", cell)
    # at most two rows a split point: safe to broadcast, and to number in one task
    tallies = placed.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n"))
    ahead = F.sum("_n").over(Window.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1))
    tallies = tallies.select("_cell", F.coalesce(ahead, F.lit(0)).alias("_ahead"))
    placed = placed.join(F.broadcast(tallies), "_cell")
    odd = F.col("_cell") % 2 != 0
    order = v.desc_nulls_last() if descending else v.asc_nulls_last()
    within = F.rank().over(Window.partitionBy("_cell").orderBy(order))
    tied = placed.where(odd).withColumn(rank_name, F.col("_ahead") + 1)
    between = placed.where(~odd).withColumn(rank_name, F.col("_ahead") + within)
    return tied.unionByName(between).withColumn(rank_name, F.col(rank_name).cast("int")).drop("_cell", "_ahead")
