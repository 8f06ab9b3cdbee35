"""Bar-table utilities: date range, de-duplication, slices, symbol filters."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

INSPECT_COLUMNS = ("symbol", "date", "open", "high", "low", "close", "volume")


def restrict_dates(bars: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Inclusive ``[start, end]`` on ``date`` (either bound optional).  On
    date-typed bars the bounds compare as dates, on RAW text as text."""
    out = bars
    if start is not None:
        out = out.where(F.col("date") >= F.lit(start).cast(bars.schema["date"].dataType))
    if end is not None:
        out = out.where(F.col("date") <= F.lit(end).cast(bars.schema["date"].dataType))
    return out


def dedupe_bars(bars: DataFrame) -> DataFrame:
    """One bar per (symbol, date): the latest ingested; the value columns
    present break remaining ties (works on a narrow projection too).  ``row_number() = 1`` plans as a partial top-1 per
    group before the shuffle, so re-delivered hot symbols cost little."""
    present = set(bars.columns)
    order = [F.col("ingested_at").desc()] + [F.col(c).desc_nulls_last() for c in
                                              ("close", "open", "high", "low", "volume", "vwap", "transactions")
                                              if c in present]
    w = Window.partitionBy("symbol", "date").orderBy(*order)
    return bars.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def inspect_symbol(bars: DataFrame, symbol: str, date_from: str, date_to: str) -> DataFrame:
    """All bars of one symbol in ``[date_from, date_to]`` by date (the
    diagnostic slice; how many of them to show is the caller's matter)."""
    return (restrict_dates(bars.where(F.col("symbol") == symbol), date_from, date_to)
            .orderBy("date").select(*INSPECT_COLUMNS))


def for_symbols(bars: DataFrame, symbols: DataFrame) -> DataFrame:
    """Bars whose symbol is in ``symbols`` (left semi join; no duplicates)."""
    return bars.join(symbols.select("symbol"), "symbol", "left_semi")
