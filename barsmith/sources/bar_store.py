"""Parquet store of bars and result sinks.

Default layout: one folder per calendar month (``month=yyyy-MM``, from the
bar's date; ``month=unparsed`` for text that is not a date), files sorted by
(symbol, date).  The folder count grows with the period, not with the number
of symbols, files stay large, and a symbol predicate skips row groups through
the Parquet min/max statistics.  ``partition_by=("symbol",)`` gives one
folder per symbol instead (fine for a few hundred symbols, a small-file
problem beyond).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import StringType, StructField, StructType

from barsmith.schemas import RAW_BARS

MONTH = "month"
UNPARSED_MONTH = "unparsed"


def month_of(date_col: str = "date") -> F.Column:
    """``yyyy-MM`` of a date or ``yyyy-MM-dd`` text; ``unparsed`` otherwise."""
    text = F.col(date_col).cast("string")
    return F.coalesce(F.date_format(F.try_to_date(text, "yyyy-MM-dd"), "yyyy-MM"), F.lit(UNPARSED_MONTH))


def write_bars(df: DataFrame, path: str, partition_by: Sequence[str] = (MONTH,),
               max_records_per_file: int = 5_000_000) -> None:
    """Overwrite ``path`` with ``df`` partitioned by ``partition_by``.

    The ``rebalance`` hint lets AQE size the write tasks (a hot partition is
    split over several tasks, small ones are packed together)."""
    out = df.withColumn(MONTH, month_of()) if MONTH in partition_by else df
    (out.hint("rebalance", *partition_by)
        .sortWithinPartitions(*partition_by, "symbol", "date")
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*partition_by)
        .parquet(path))


def read_bars(spark: SparkSession, path: str, schema=RAW_BARS,
              month_from: str | None = None, month_to: str | None = None) -> DataFrame:
    """Read a bar store back with a fixed schema (partition values are never
    type-inferred: a lone symbol such as ``1E5`` stays a string).  Month
    bounds (``yyyy-MM``, inclusive) prune folders of a month-partitioned
    store and compare the bar's own month in a store without such folders.
    Bars whose date does not parse have no month and stay."""
    names = [f.name for f in schema.fields]
    # the month column is part of the read schema so that neither layout
    # triggers partition-type inference; it reads as NULL in a symbol layout
    read_schema = StructType(list(schema.fields) + [StructField(MONTH, StringType(), True)])
    df = spark.read.schema(read_schema).option("basePath", path).parquet(path)
    folder, own = F.col(MONTH), month_of()

    def bounded(test) -> F.Column:
        # the first two arms only read the folder, so they prune
        return (folder == UNPARSED_MONTH) | test(folder) | (folder.isNull() & (test(own) | (own == UNPARSED_MONTH)))

    if month_from is not None:
        df = df.where(bounded(lambda m: m >= month_from))
    if month_to is not None:
        df = df.where(bounded(lambda m: m <= month_to))
    return df.select(*names)


def write_clustered(df: DataFrame, path: str, files: int | None = None, row_group_bytes: int = 16 << 20, bloom_distinct: int = 100_000) -> None:
    """Overwrite ``path`` with ``df`` laid out for symbol slices: range-clustered
    by (symbol, date), so that a symbol lies in one run of neighbouring files,
    which are sorted, with min/max statistics per row group and a bloom filter on
    the symbol for those whose range covers a symbol they don't hold.

    A symbol that holds a third of all bars is cut by date over many files."""
    count = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartitionByRange(count, "symbol", "date").sortWithinPartitions("symbol", "date")
        .write.mode("overwrite")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.bloom.filter.enabled#symbol", "true")
        .option("parquet.bloom.filter.expected.ndv#symbol", bloom_distinct)
        .parquet(path))


def read_slice(spark: SparkSession, path: str, symbols: Sequence[str], date_from: str | None = None, date_to: str | None = None, schema=RAW_BARS) -> DataFrame:
    """The bars of ``symbols`` from a clustered store.  The conditions reach the
    reader, which skips row groups by statistics and bloom filter."""
    out = spark.read.schema(schema).parquet(path).where(F.col("symbol").isin(*symbols))
    if date_from is not None:
        out = out.where(F.col("date") >= date_from)
    if date_to is not None:
        out = out.where(F.col("date") <= date_to)
    return out


def write_ranked(df: DataFrame, path: str, by: Sequence[str] = ("rank", "symbol"), files: int | None = None) -> None:
    """Overwrite ``path`` with ``df`` in the order of ``by``: files are ranges,
    numbered in that order by name (``part-00000`` first), and sorted inside."""
    count = files or min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1024)
    df.repartitionByRange(count, *by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)


def read_ranked(spark: SparkSession, path: str, schema: StructType, first: int | None = None, by: Sequence[str] = ("rank", "symbol")) -> DataFrame:
    """A result that :func:`write_ranked` stored, in rank order: all rows, or
    those ranked up to ``first``, for which only the first files are read."""
    out = spark.read.schema(schema).parquet(path)
    return (out if first is None else out.where(F.col(by[0]) <= first)).orderBy(*by)


def write_result(df: DataFrame, path: str) -> None:
    """Overwrite one result folder (also when the result is empty)."""
    df.write.mode("overwrite").parquet(path)
