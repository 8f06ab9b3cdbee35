"""Print the RAW bars of one symbol in a date range (first 100 by date)."""
from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barsmith.operators.bars import inspect_symbol  # noqa: E402
from barsmith.plans.job import stored_raw  # noqa: E402
from barsmith.schemas import RAW_BARS  # noqa: E402
from barsmith.session import get_session  # noqa: E402
from barsmith.sources.bar_store import read_bars  # noqa: E402


def main(argv=None) -> int:
    p = argparse.ArgumentParser()
    p.add_argument("--symbol", required=True)
    p.add_argument("--from", dest="date_from", default="2025-01-01")
    p.add_argument("--to", dest="date_to", default="2025-12-31")
    p.add_argument("--output", default="output")
    a = p.parse_args(argv)
    spark = get_session("barsmith-inspect")
    raw = read_bars(spark, stored_raw(spark, a.output) or f"{a.output.rstrip('/')}/raw", RAW_BARS,
                    month_from=a.date_from[:7], month_to=a.date_to[:7])
    inspect_symbol(raw, a.symbol, a.date_from, a.date_to).show(100, truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
