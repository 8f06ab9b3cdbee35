from __future__ import annotations

import pytest

from barsmith.operators import quality
from barsmith.plans import inputs
from barsmith.schemas import VALID_BARS
from tests.conftest import SF001, make_raw


def reasons(spark, rows):
    flagged = quality.flag(make_raw(spark, rows))
    return [r.failure_reason for r in flagged.orderBy("volume").select("failure_reason").collect()]


@pytest.mark.parametrize("row,reason", [
    ({"symbol": None}, "non_null_symbol"),
    ({"symbol": "   "}, "non_null_symbol"),
    ({"date": None}, "non_null_date"),
    ({"date": "2025/01/02"}, "non_null_date"),
    ({"close": None}, "non_null_close"),
    ({"close": 0.0, "open": 0.0, "high": 0.0, "low": 0.0}, "positive_close"),
    ({"close": -5.0, "open": -5.0, "high": -4.0, "low": -6.0}, "positive_close"),
    ({"open": None}, "non_null_open"),
    ({"open": 0.005}, "positive_open"),
    ({"high": 140.0, "low": 160.0, "close": 150.0, "open": 150.0}, "high_gte_low"),
    ({"close": 200.0, "high": 180.0, "low": 170.0, "open": 175.0}, "high_gte_close"),
    ({"close": 100.0, "low": 100.5, "high": 101.0}, "low_lte_close"),
    ({"volume": -1}, "non_negative_volume"),
    ({"high": None}, "high_gte_low"),
    ({"low": None}, "high_gte_low"),
])
def test_first_failing_rule(spark, row, reason):
    assert reasons(spark, [row]) == [reason]


def test_good_row_and_null_volume_pass(spark):
    assert reasons(spark, [{}, {"volume": None}]) == [None, None]


def test_null_high_is_quarantined_not_lost(spark):
    flagged = quality.flag(make_raw(spark, [{"high": None}, {"volume": 1}]))
    assert quality.valid(flagged).count() == 1
    assert quality.quarantine(flagged).count() == 1


def test_mixed_pass_rate_and_metrics(spark):
    flagged = quality.flag(make_raw(spark, [{}, {"close": None}, {"volume": 7}, {"open": None}]))
    m = quality.metrics(flagged).collect()[0]
    assert (m.total_input, m.total_valid, m.total_quarantine, m.pass_rate) == (4, 2, 2, 0.5)
    empty = quality.metrics(quality.flag(make_raw(spark, []))).collect()[0]
    assert empty.pass_rate == 1.0 and empty.total_input == 0


def test_quarantine_keeps_raw_date_text(spark):
    q = quality.quarantine(quality.flag(make_raw(spark, [{"date": "bad-date"}]))).collect()[0]
    assert q.date is None and q.date_raw == "bad-date" and q.failure_reason == "non_null_date"


def test_valid_schema_order(spark):
    v = quality.valid(quality.flag(make_raw(spark, [{}])))
    assert [f.name for f in v.schema] == [f.name for f in VALID_BARS]


def test_lossless_on_corrupted_driver_bars(spark):
    flagged = quality.flag(inputs.raw_bars(spark, SF001))
    total = flagged.count()
    v = quality.valid(flagged).count()
    q = quality.quarantine(flagged).count()
    assert v + q == total and q > 0
    by_reason = {r.failure_reason: r.n for r in quality.reason_counts(flagged).collect()}
    assert sum(by_reason.values()) == q


def test_nan_prices_caught_only_by_optional_rule(spark):
    nan = float("nan")
    rows = [{"close": nan, "open": nan, "high": nan, "low": nan}]
    assert reasons(spark, rows) == [None]
    flagged = quality.flag(make_raw(spark, rows), quality.rules(finite_prices=True))
    assert [r.failure_reason for r in flagged.collect()] == ["finite_prices"]


def test_metrics_from_outcome_counts_equal_direct_metrics(spark):
    flagged = quality.flag(inputs.raw_bars(spark, SF001))
    counts = quality.outcome_counts(flagged)
    assert quality.metrics_from_counts(counts).collect() == quality.metrics(flagged).collect()
    assert quality.metrics_from_counts(quality.outcome_counts(quality.flag(make_raw(spark, [])))).collect()[0].pass_rate == 1.0
    reasons = counts.where("failure_reason is not null")
    assert sorted(reasons.collect()) == sorted(quality.reason_counts(flagged).collect())
