"""Ticker-symbol column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: accepted ticker format (1-5 capitals, optional class suffix).
SYMBOL_PATTERN = r"^[A-Z]{1,5}(\.[A-Z]{1,2})?$"


def normalise_symbol(symbol: Column) -> Column:
    """White space of any kind off both ends, upper case; NULL stays NULL."""
    return F.upper(F.regexp_replace(symbol, r"(?U)^\s+|\s+$", ""))


def symbol_format_ok(symbol: Column) -> Column:
    return symbol.rlike(SYMBOL_PATTERN)

