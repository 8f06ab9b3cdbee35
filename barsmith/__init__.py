"""barsmith: Spark-native analytics over daily market-price bars.

Every public operator is a lazy ``DataFrame -> DataFrame`` function built from
Spark's own column functions, joins, aggregates and windows.  Actions happen
only in :mod:`barsmith.plans.job`.

The common entry points are re-exported here::

    import barsmith as bs
    flagged = bs.flag(raw)
    ranked = bs.relative_increase(bs.valid(flagged))
"""

from barsmith.operators.anchors import first_last, first_last_window, last_where
from barsmith.operators.bars import dedupe_bars, for_symbols, inspect_symbol, restrict_dates
from barsmith.operators.quality import flag, metrics, quarantine, reason_counts, rules, valid
from barsmith.operators.ranking import global_rank
from barsmith.operators.tickers import duplicates, report, valid_symbols, vet_tickers
from barsmith.plans.analytics import (
    monthly_cagr,
    relative_increase,
    symbol_anchors,
    weekly_returns,
    winners,
    worst_weeks,
)
from barsmith.plans.job import JobConfig, run
from barsmith.plans.portfolio import portfolio_detail, portfolio_summary
from barsmith.session import get_session
from barsmith.sources.bar_store import read_bars, write_bars
from barsmith.sources.company_list import read_company_list
from barsmith.sources.payloads import bars_from_payloads, read_payload_files

__version__ = "0.1.0"

__all__ = [
    "JobConfig", "bars_from_payloads", "dedupe_bars", "duplicates", "first_last", "first_last_window", "flag",
    "for_symbols", "get_session", "global_rank", "inspect_symbol", "last_where", "metrics", "monthly_cagr",
    "portfolio_detail", "portfolio_summary", "quarantine", "read_bars", "read_company_list", "read_payload_files",
    "reason_counts", "relative_increase", "report", "restrict_dates", "rules", "run", "symbol_anchors", "valid",
    "valid_symbols", "vet_tickers", "weekly_returns", "winners", "worst_weeks", "write_bars",
]
