"""Fixed schemas of every layer.  Nothing is inferred."""
from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _s(*fields: tuple[str, object, bool]) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


COMPANY_LIST = _s(("company_name", StringType(), False), ("symbol", StringType(), False))

RAW_BARS = _s(
    ("symbol", StringType(), False),
    ("date", StringType(), False),  # yyyy-MM-dd text as delivered
    ("open", DoubleType(), True),
    ("high", DoubleType(), True),
    ("low", DoubleType(), True),
    ("close", DoubleType(), True),
    ("volume", LongType(), True),
    ("vwap", DoubleType(), True),
    ("transactions", LongType(), True),
    ("ingested_at", TimestampType(), False),
)

VALID_BARS = _s(
    ("symbol", StringType(), False),
    ("date", DateType(), False),
    ("open", DoubleType(), False),
    ("high", DoubleType(), False),
    ("low", DoubleType(), False),
    ("close", DoubleType(), False),
    ("volume", LongType(), True),
    ("vwap", DoubleType(), True),
    ("transactions", LongType(), True),
    ("ingested_at", TimestampType(), False),
)

# Quarantine keeps the raw columns with the parsed date, the original text and
# the first failing rule.
QUARANTINE = StructType(
    [f if f.name != "date" else StructField("date", DateType(), True) for f in RAW_BARS.fields]
    + [StructField("date_raw", StringType(), True), StructField("failure_reason", StringType(), True)]
)

RELATIVE_INCREASE = _s(
    ("symbol", StringType(), False),
    ("start_price", DoubleType(), False),
    ("end_price", DoubleType(), False),
    ("relative_increase", DoubleType(), False),
    ("relative_increase_pct", DoubleType(), False),
    ("rank", IntegerType(), False),
)

PORTFOLIO_DETAIL = _s(
    ("symbol", StringType(), False),
    ("start_price", DoubleType(), False),
    ("end_price", DoubleType(), False),
    ("shares_purchased", LongType(), False),
    ("capital_invested", DoubleType(), False),
    ("uninvested_cash", DoubleType(), False),
    ("current_value", DoubleType(), False),
    ("pnl", DoubleType(), False),
)

PORTFOLIO_SUMMARY = _s(
    ("total_capital_invested", DoubleType(), False),
    ("total_uninvested_cash", DoubleType(), False),
    ("total_current_value", DoubleType(), False),
    ("total_pnl", DoubleType(), False),
    ("total_return_pct", DoubleType(), False),
    ("residual_cash", DoubleType(), False),
)

MONTHLY_CAGR = _s(
    ("symbol", StringType(), False),
    ("start_price", DoubleType(), False),
    ("end_price", DoubleType(), False),
    ("n_months", IntegerType(), False),
    ("monthly_cagr", DoubleType(), False),
    ("rank", IntegerType(), False),
)

WEEKLY_RETURNS = _s(
    ("symbol", StringType(), False),
    ("year", IntegerType(), False),
    ("week_of_year", IntegerType(), False),
    ("week_start", DateType(), False),
    ("week_end", DateType(), False),
    ("start_price", DoubleType(), False),
    ("end_price", DoubleType(), False),
    ("weekly_return", DoubleType(), False),
    ("weekly_return_pct", DoubleType(), False),
)

# One bar inside a landed response envelope.  ``t``, ``v`` and ``n`` are read as
# doubles: vendors send ``1000000.0`` and a bigint field would turn it into NULL.
PAYLOAD_BAR = _s(
    ("t", DoubleType(), True),
    ("o", DoubleType(), True),
    ("h", DoubleType(), True),
    ("l", DoubleType(), True),
    ("c", DoubleType(), True),
    ("v", DoubleType(), True),
    ("vw", DoubleType(), True),
    ("n", DoubleType(), True),
)

PAYLOAD = _s(
    ("ticker", StringType(), True),
    ("status", StringType(), True),
    ("error", StringType(), True),
    ("resultsCount", LongType(), True),
    ("results", ArrayType(PAYLOAD_BAR), True),
)

# Reference record per ticker, as of a date.  ``http_status`` NULL means the
# lookup never got an answer.
TICKER_REFERENCE = _s(
    ("symbol", StringType(), False),
    ("http_status", IntegerType(), True),
    ("active", BooleanType(), True),
    ("type", StringType(), True),
    ("name", StringType(), True),
    ("as_of", DateType(), True),
)

# ``outcome``: valid | invalid | duplicate (a repeat, only warned about)
TICKER_VETTING = _s(
    ("position", LongType(), False),
    ("symbol", StringType(), False),
    ("outcome", StringType(), False),
    ("reason", StringType(), True),
    ("warning", StringType(), True),
    ("matched_name", StringType(), True),
)

VALIDATION_METRICS = _s(
    ("total_input", LongType(), False),
    ("total_valid", LongType(), False),
    ("total_quarantine", LongType(), False),
    ("pass_rate", DoubleType(), False),
)
