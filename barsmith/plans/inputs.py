"""Standard inputs of the registered queries, all derived by Spark from the
driver's parquet tables (see FIXTURES.md)."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.operators import quality
from barsmith.sources import lineitem_bars as lb
from barsmith.sources import payloads
from barsmith.sources.tables import spread, table


def bars(spark: SparkSession, data_dir: str, symbol: str | None = None) -> DataFrame:
    """Validated-layout bars: one per (supplier ticker, ship day), whole table
    or those of one symbol."""
    return lb.bars_from_trades(trades(spark, data_dir, symbol))


def trades(spark: SparkSession, data_dir: str, symbol: str | None = None) -> DataFrame:
    """Priced line items, whole table or those of one symbol: a symbol stands for
    one key, so the condition reaches the scan."""
    items = table(spark, data_dir, "lineitem")
    if symbol is not None:
        return lb.trade_prices(items.where(F.col("l_suppkey") == F.lit(lb.key_of(symbol))))
    return lb.trade_prices(spread(items, "l_orderkey"))


def symbol_keys(spark: SparkSession, data_dir: str, symbols: DataFrame) -> DataFrame:
    """The keys of the suppliers whose symbol is in ``symbols``."""
    known = table(spark, data_dir, "supplier").selectExpr("s_suppkey as key", lb.symbol_of("s_suppkey") + " as symbol")
    return known.join(symbols.select("symbol"), "symbol", "left_semi").select("key")


def raw_bars(spark: SparkSession, data_dir: str, symbol: str | None = None) -> DataFrame:
    return lb.raw_bars_from_bars(bars(spark, data_dir, symbol))


def valid_bars(spark: SparkSession, data_dir: str) -> DataFrame:
    """RAW bars through the quality gate: what the analytics consume."""
    return quality.valid(quality.flag(raw_bars(spark, data_dir)))


def company_list(spark: SparkSession, data_dir: str) -> DataFrame:
    return lb.company_list_from_supplier(table(spark, data_dir, "supplier"))


def ticker_reference(spark: SparkSession, data_dir: str) -> DataFrame:
    return lb.ticker_reference_from_supplier(table(spark, data_dir, "supplier"))


def responses(spark: SparkSession, data_dir: str, never_landed: str | None = lb.NEVER_LANDED_LETTER) -> DataFrame:
    """Landed responses, read; none came for symbols that end in ``never_landed``."""
    return payloads.parse_payload_lines(lb.payload_lines_from_bars(bars(spark, data_dir), never_landed))


def landed_bars(spark: SparkSession, data_dir: str, never_landed: str | None = lb.NEVER_LANDED_LETTER) -> DataFrame:
    """RAW bars as they come out of the landed-envelope scan."""
    return payloads.bars_from_payloads(responses(spark, data_dir, never_landed), lb.DERIVED_INGESTED_AT)


def reference_history(spark: SparkSession, data_dir: str) -> DataFrame:
    return lb.reference_history_from_lineitem(table(spark, data_dir, "lineitem"))


def listings(spark: SparkSession, data_dir: str) -> DataFrame:
    """Company list with positions plus the hand-made edge listings."""
    return lb.with_edge_listings(company_list(spark, data_dir))
