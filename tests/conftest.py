from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barsmith.schemas import RAW_BARS, VALID_BARS  # noqa: E402
from barsmith.session import get_session  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session("barsmith-tests", conf={"spark.master": "local[*]", "spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="barsmith-test-")


STAMP = dt.datetime(2026, 1, 5)


def make_bars(spark, rows):
    """Validated bars from (symbol, 'yyyy-MM-dd', close): open=high=low=close,
    volume 1,000,000, transactions 1000."""
    data = [(s, dt.date.fromisoformat(d), c, c, c, c, 1_000_000, c, 1000, STAMP) for s, d, c in rows]
    return spark.createDataFrame(data, VALID_BARS)


def make_raw(spark, rows):
    """RAW bars from dicts; missing keys default to a good bar (close 100)."""
    out = []
    for r in rows:
        close = r.get("close", 100.0)
        base = {"symbol": "GOOD", "date": "2025-01-02", "open": 99.0 if close is None else close - 1,
                "high": 101.0 if close is None else close + 1, "low": 99.5 if close is None else close - 0.5,
                "close": close, "volume": 1000, "vwap": None, "transactions": None, "ingested_at": STAMP}
        base.update(r)
        out.append(tuple(base[f.name] for f in RAW_BARS.fields))
    return spark.createDataFrame(out, RAW_BARS.__class__([f.__class__(f.name, f.dataType, True) for f in RAW_BARS.fields]))
