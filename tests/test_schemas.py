"""Every layer's output has the declared column names and types, in order."""
from __future__ import annotations

import pytest

from barsmith import schemas
from barsmith.operators import quality, tickers
from barsmith.plans import analytics, inputs, portfolio
from tests.conftest import SF0001


def shape(struct):
    return [(f.name, f.dataType.simpleString()) for f in struct.fields]


@pytest.fixture(scope="module")
def flagged(spark):
    return quality.flag(inputs.raw_bars(spark, SF0001))


def test_raw_and_valid_and_quarantine(spark, flagged):
    assert shape(inputs.raw_bars(spark, SF0001).schema) == shape(schemas.RAW_BARS)
    assert shape(quality.valid(flagged).schema) == shape(schemas.VALID_BARS)
    assert shape(quality.quarantine(flagged).schema) == shape(schemas.QUARANTINE)
    assert shape(quality.metrics(flagged).schema) == shape(schemas.VALIDATION_METRICS)


def test_landed_bars_are_raw(spark):
    assert shape(inputs.landed_bars(spark, SF0001).schema) == shape(schemas.RAW_BARS)


def test_analytics_outputs(spark, flagged):
    v = quality.valid(flagged)
    assert shape(analytics.relative_increase(v).schema) == shape(schemas.RELATIVE_INCREASE)
    assert shape(analytics.monthly_cagr(v).schema) == shape(schemas.MONTHLY_CAGR)
    assert shape(analytics.worst_weeks(v).schema) == shape(schemas.WEEKLY_RETURNS)
    assert shape(portfolio.portfolio_detail(v).schema) == shape(schemas.PORTFOLIO_DETAIL)
    assert shape(portfolio.portfolio_summary(v).schema) == shape(schemas.PORTFOLIO_SUMMARY)


def test_vetting_output(spark):
    v = tickers.vet_tickers(inputs.listings(spark, SF0001), inputs.ticker_reference(spark, SF0001))
    assert shape(v.schema) == shape(schemas.TICKER_VETTING)
    assert shape(inputs.ticker_reference(spark, SF0001).schema) == shape(schemas.TICKER_REFERENCE)
