"""Date column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_DATE = "yyyy-MM-dd"


MS_PER_DAY = 86_400_000


def epoch_ms_to_date(ms: Column) -> Column:
    """Epoch milliseconds -> UTC calendar date, by day arithmetic (independent
    of the session time zone).  A missing timestamp counts as 0 (1970-01-01)."""
    return F.date_from_unix_date(F.floor(F.coalesce(ms, F.lit(0)) / MS_PER_DAY).cast("int"))


def date_to_epoch_ms(date: Column) -> Column:
    """UTC midnight of ``date`` in epoch milliseconds."""
    return F.unix_date(date).cast("long") * MS_PER_DAY


def epoch_ms_to_iso_date(ms: Column) -> Column:
    """Epoch milliseconds -> UTC calendar date as ``yyyy-MM-dd`` text."""
    return F.date_format(epoch_ms_to_date(ms), ISO_DATE)


def parse_iso_date(text: Column) -> Column:
    """``yyyy-MM-dd`` text -> date; NULL (not an error) on bad input."""
    return F.try_to_date(text, ISO_DATE)


def week_monday(date: Column) -> Column:
    """Monday of the ISO week that contains ``date`` (``dayofweek``: Sunday=1,
    Monday=2), pure date arithmetic."""
    return F.date_sub(date, F.pmod(F.dayofweek(date) - 2, F.lit(7)))
