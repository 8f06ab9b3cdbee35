"""The four questions asked of validated bars (T1-T4).

All are thin projections over :func:`barsmith.operators.anchors.first_last`:
one partial+final hash aggregate per question, no self-joins, no driver work.
T1-T3 also take the per-symbol :func:`symbol_anchors` table, which lets the
job answer all three from one scan of the bars.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.functions.dates import week_monday
from barsmith.functions.numeric import compound_growth, percent, relative_change
from barsmith.operators.anchors import first_last, last_where
from barsmith.operators.ranking import global_rank


# ------------------------------------------------------------------ anchors
def symbol_anchors(
    bars: DataFrame,
    start_month: int = 1,
    end_month: int = 6,
    year: int | None = None,
) -> DataFrame:
    """Everything T1, T2 and T3 need, in one per-symbol aggregate: first and
    last close of the period, bar count, and the last close of
    ``start_month`` / ``end_month`` (of ``year``, or the latest of any year).

    One row per symbol -- small next to the bars -- so a job can persist it
    once and answer three questions from it with a single scan of the bars."""
    month = F.month("date")
    in_year: Column = F.lit(True) if year is None else (F.year("date") == year)
    return first_last(
        bars.select("symbol", "date", "close"),
        extra=[
            F.count(F.lit(1)).alias("n_points"),
            last_where(in_year & (month == start_month)).alias("month_start_price"),
            last_where(in_year & (month == end_month)).alias("month_end_price"),
        ],
    )


# --------------------------------------------------------------------------- T1
def relative_increase_from_anchors(anchors: DataFrame, min_points: int = 1) -> DataFrame:
    """T1 over :func:`symbol_anchors` output."""
    return global_rank(increases(anchors, min_points), "relative_increase").select(*T1_COLUMNS).orderBy("rank", "symbol")


T1_COLUMNS = ("symbol", "start_price", "end_price", "relative_increase", "relative_increase_pct", "rank")


def increases(anchors: DataFrame, min_points: int = 1) -> DataFrame:
    """T1 without the rank."""
    return anchors.where((F.col("start_price") > 0) & (F.col("n_points") >= min_points)).select(
        "symbol",
        "start_price",
        "end_price",
        relative_change(F.col("start_price"), F.col("end_price")).alias("relative_increase"),
    ).withColumn("relative_increase_pct", percent(F.col("relative_increase")))


def relative_increase(bars: DataFrame, min_points: int = 1) -> DataFrame:
    """Per symbol: first and last close of the period, relative increase,
    percent (4 dp) and rank (1 = greatest increase, gaps on ties).

    ``min_points=1`` keeps single-bar symbols (increase 0.0) like the code it
    replaces; ``min_points=2`` applies the documented exclusion."""
    return relative_increase_from_anchors(increase_anchors(bars), min_points)


def increase_anchors(bars: DataFrame) -> DataFrame:
    return first_last(bars.select("symbol", "date", "close"), extra=[F.count(F.lit(1)).alias("n_points")])


def increase_winners(bars: DataFrame) -> DataFrame:
    """The T1 rows ranked first, without ranking the others."""
    return winners(increases(increase_anchors(bars)), "relative_increase").select(*T1_COLUMNS)


def winners(scored: DataFrame, value: str) -> DataFrame:
    """Rows of the greatest value (several on a tie), as rank 1: the maximum is
    one aggregate, read back as a scalar."""
    best = scored.agg(F.max(value)).scalar()
    return scored.where(F.col(value) == best).withColumn("rank", F.lit(1))


# --------------------------------------------------------------------------- T3
def monthly_cagr_from_anchors(anchors: DataFrame, n_months: int = 5) -> DataFrame:
    """T3 over :func:`symbol_anchors` output."""
    return global_rank(growths(anchors, n_months), "monthly_cagr").select(*T3_COLUMNS).orderBy("rank", "symbol")


T3_COLUMNS = ("symbol", "start_price", "end_price", "n_months", "monthly_cagr", "rank")


def growths(anchors: DataFrame, n_months: int = 5) -> DataFrame:
    """T3 without the rank."""
    start, end = F.col("month_start_price"), F.col("month_end_price")
    return anchors.where(start.isNotNull() & end.isNotNull() & (start > 0)).select(
        "symbol",
        start.alias("start_price"),
        end.alias("end_price"),
        F.lit(n_months).cast("int").alias("n_months"),
        compound_growth(start, end, n_months).alias("monthly_cagr"),
    )


def monthly_cagr(
    bars: DataFrame,
    n_months: int = 5,
    start_month: int = 1,
    end_month: int = 6,
    year: int | None = None,
) -> DataFrame:
    """Compound monthly growth from the last close of ``start_month`` to the
    last close of ``end_month``.

    ``year=None`` takes the latest such month of any year (the behaviour of
    the code this replaces); give a year to pin both months.  ``n_months`` is
    only the exponent.  Symbols lacking either month are excluded."""
    return monthly_cagr_from_anchors(month_anchors(bars, start_month, end_month, year), n_months)


def month_anchors(bars: DataFrame, start_month: int = 1, end_month: int = 6, year: int | None = None) -> DataFrame:
    month = F.month("date")
    in_year: Column = F.lit(True) if year is None else (F.year("date") == year)
    return bars.groupBy("symbol").agg(
        last_where(in_year & (month == start_month)).alias("month_start_price"),
        last_where(in_year & (month == end_month)).alias("month_end_price"),
    )


def growth_winners(bars: DataFrame) -> DataFrame:
    """The T3 rows ranked first, without ranking the others."""
    return winners(growths(month_anchors(bars)), "monthly_cagr").select(*T3_COLUMNS)


# --------------------------------------------------------------------------- T4
WEEKLY_COLUMNS = (
    "symbol", "year", "week_of_year", "week_start", "week_end",
    "start_price", "end_price", "weekly_return", "weekly_return_pct",
)


def weekly_returns(bars: DataFrame, min_days: int = 2, keep_monday: bool = False) -> DataFrame:
    """Return of every (symbol, ISO week): first to last close of the week.

    Weeks are keyed by their Monday (calendar-year boundaries cannot merge
    weeks).  ``year`` is the calendar year of that Monday and ``week_of_year``
    its ISO week number, so Monday 2024-12-30 is labelled 2024 / 1."""
    weekly = bars.select("symbol", "date", "close", week_monday(F.col("date")).alias("week_monday"))
    anchors = first_last(
        weekly,
        by=["symbol", "week_monday"],
        extra=[
            F.min("date").alias("week_start"),
            F.max("date").alias("week_end"),
            F.count("date").alias("n_trading_days"),
        ],
    )
    out = anchors.where((F.col("n_trading_days") >= min_days) & (F.col("start_price") > 0)).select(
        "symbol",
        F.year("week_monday").alias("year"),
        F.weekofyear("week_monday").alias("week_of_year"),
        "week_start",
        "week_end",
        "start_price",
        "end_price",
        relative_change(F.col("start_price"), F.col("end_price")).alias("weekly_return"),
        *(["week_monday"] if keep_monday else []),
    ).withColumn("weekly_return_pct", percent(F.col("weekly_return")))
    return out.select(*WEEKLY_COLUMNS, *(["week_monday"] if keep_monday else []))


def week_days(bars: DataFrame) -> DataFrame:
    """First and last trading day and day count of every (symbol, week)."""
    return bars.groupBy("symbol", week_monday(F.col("date")).alias("week_monday")).agg(
        F.min("date").alias("week_start"), F.max("date").alias("week_end"), F.count("date").alias("n_trading_days"))


def worst_weeks(bars: DataFrame, k: int = 1, min_days: int = 2) -> DataFrame:
    """The ``k`` weeks with the lowest return (the greatest decrease).

    Ties break by symbol then week start.  ``orderBy().limit(k)`` plans as a
    per-partition top-k plus a final merge of k rows per partition."""
    return (weekly_returns(bars, min_days=min_days)
            .orderBy(F.col("weekly_return").asc(), F.col("symbol").asc(), F.col("week_start").asc())
            .limit(k))
