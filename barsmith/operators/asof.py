"""As-of lookups: for each row the latest record of its key known on its own date.

Rows and records are laid on one time line by a union, sorted by key and time,
and each row takes the last record so far.  A key's time line is cut into
slices, so that a key that holds a third of all rows is worked on slice by
slice: inside a slice the last record so far is a window over (key, slice), and
what a slice starts with comes from a window over one row a (key, slice), the
last record of each.  Equal (key, date) pairs are looked up once.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key by ``order`` (a partial top-1 before the shuffle)."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def as_of(rows: DataFrame, records: DataFrame, by: str, at: str, known: str, prefer: Sequence[Column] = (), unit: str = "quarter") -> DataFrame:
    """``rows`` with the columns of ``records`` (other than ``by``, which both
    have): the record of the row's ``by`` with the latest date ``known`` on or
    before the row's date ``at``; NULLs if there is none.

    A record without a date was always known; of records of one key and date the
    first by ``prefer`` counts; a row without key or date finds none.  ``unit``
    is the width of a time slice (any unit of ``trunc``)."""
    values = [c for c in records.columns if c != by]
    record = F.struct(*[F.col(f"`{c}`").alias(c) for c in values])
    told = first_by(records.where(F.col(by).isNotNull()), [by, known], [*prefer, *[F.col(f"`{c}`").asc_nulls_last() for c in values]])
    told = told.select(F.col(by).alias("_by"), F.coalesce(F.col(known).cast("date"), F.lit("0001-01-01").cast("date")).alias("_t"), record.alias("_record"))
    asked = rows.where(F.col(by).isNotNull() & F.col(at).isNotNull()).select(F.col(by).alias("_by"), F.col(at).cast("date").alias("_t")).distinct()
    line = told.withColumn("_asks", F.lit(0)).unionByName(asked.withColumn("_asks", F.lit(1)), allowMissingColumns=True)
    line = line.withColumn("_slice", F.trunc("_t", unit))
    so_far = Window.partitionBy("_by", "_slice").orderBy("_t", "_asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    line = line.withColumn("_here", F.last("_record", ignorenulls=True).over(so_far))
    # one row a (key, slice): its last record, and from that the last of all slices before
    # (a record is told apart from none by its date, as all its values may be NULL)
    slices = line.groupBy("_by", "_slice").agg(F.max_by("_record", F.when(F.col("_asks") == 0, F.col("_t"))).alias("_last"))
    earlier = Window.partitionBy("_by").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("_by", "_slice", F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
    found = (line.where("_asks = 1").join(slices, ["_by", "_slice"])
             .select("_by", "_t", F.coalesce("_here", "_before").alias("_found")))
    out = rows.join(found, (rows[by] == found["_by"]) & (rows[at].cast("date") == found["_t"]), "left")
    return out.select(*[rows[c] for c in rows.columns], *[F.col("_found")[c].alias(c) for c in values])
