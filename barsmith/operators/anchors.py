"""First / last value per group.

The shared core of all four analytics.  One hash aggregate with
``min_by``/``max_by``: partial aggregation runs map-side, so a symbol holding a
third of all bars costs one small partial row per task before the shuffle,
and the plan has one exchange instead of two window sorts plus a self-join.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(by: str | Column | Sequence[str | Column]) -> list[str | Column]:
    return [by] if isinstance(by, (str, Column)) else list(by)


def first_last(
    df: DataFrame,
    by: str | Column | Sequence[str | Column] = "symbol",
    value: str = "close",
    order: str = "date",
    first_name: str = "start_price",
    last_name: str = "end_price",
    where_first: Column | None = None,
    where_last: Column | None = None,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Per group: ``value`` at the smallest and at the largest ``order``.

    ``where_first``/``where_last`` restrict which rows may serve as the
    anchor (an aggregate FILTER); a group with no qualifying row gets NULL.
    ``order`` must be unique within a group for a deterministic result."""
    ordered = F.col(order)

    def pick(fn, cond: Column | None) -> Column:
        if cond is None:
            return fn(F.col(value), ordered)
        # rows outside the filter get a NULL order key and are ignored by min_by/max_by
        return fn(F.when(cond, F.col(value)), F.when(cond, ordered))

    return df.groupBy(*_cols(by)).agg(
        pick(F.min_by, where_first).alias(first_name),
        pick(F.max_by, where_last).alias(last_name),
        *extra,
    )


def last_where(cond: Column, value: str = "close", order: str = "date") -> Column:
    """Aggregate: ``value`` at the largest ``order`` among rows where ``cond``
    holds (``max_by ... FILTER (WHERE cond)``); NULL when no row qualifies."""
    return F.max_by(F.when(cond, F.col(value)), F.when(cond, F.col(order)))


def first_last_window(
    df: DataFrame,
    by: str | Sequence[str] = "symbol",
    value: str = "close",
    order: str = "date",
    first_name: str = "start_price",
    last_name: str = "end_price",
) -> DataFrame:
    """:func:`first_last` by one window: each group's first row in order, with
    the value of its last row beside it.  One shuffle and one sort; the
    aggregate form moves less and is the one the analytics use."""
    keys = _cols(by)
    ordered = Window.partitionBy(*keys).orderBy(order)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = df.select(*keys, F.col(value).alias(first_name), F.last(value).over(whole).alias(last_name),
                       F.row_number().over(ordered).alias("_place"))
    return placed.where("_place = 1").drop("_place")
