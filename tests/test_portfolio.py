from __future__ import annotations

import random
from collections import Counter
from decimal import Decimal

import pytest

from barsmith.plans.portfolio import portfolio_detail, portfolio_summary
from tests.conftest import make_bars


def bars_from_prices(spark, prices):
    rows = []
    for sym, (start, end) in prices.items():
        rows += [(sym, "2025-01-02", start), (sym, "2025-12-31", end)]
    return make_bars(spark, rows)


def sequential(prices, budget=10_000):
    """The rule one share at a time: every symbol spends its own budget while a
    share still fits, then the change of all buys single shares, always of the
    cheapest symbol that it can pay."""
    cost = {sym: Decimal(str(start)) for sym, (start, _) in prices.items()}
    shares, change = Counter(), Decimal(0)
    for sym, price in cost.items():
        purse = Decimal(str(budget))
        while purse >= price:
            purse -= price
            shares[sym] += 1
        change += purse
    while (affordable := [(price, sym) for sym, price in cost.items() if price <= change]):
        price, sym = min(affordable)
        change -= price
        shares[sym] += 1
    return {sym: shares[sym] for sym in prices}, change


def test_whole_shares_and_remainder(spark):
    detail = {r.symbol: r for r in portfolio_detail(bars_from_prices(spark, {"X": (100.0, 120.0)})).collect()}
    assert detail["X"].shares_purchased == 100 and detail["X"].capital_invested == 10_000.0
    assert detail["X"].current_value == 12_000.0 and detail["X"].pnl == 2_000.0
    detail = {r.symbol: r for r in portfolio_detail(bars_from_prices(spark, {"X": (101.0, 120.0)})).collect()}
    # 99 shares leave 1.0, which buys nothing more: the row keeps it
    assert detail["X"].shares_purchased == 99 and detail["X"].uninvested_cash == pytest.approx(1.0)


def test_pool_goes_to_the_cheapest(spark):
    prices = {"CHEAP": (1.0, 2.0), "EXPENSIVE": (9999.0, 10000.0)}
    detail = {r.symbol: r for r in portfolio_detail(bars_from_prices(spark, prices)).collect()}
    assert detail["EXPENSIVE"].shares_purchased == 1
    # EXPENSIVE leaves 1.0 in the pool: one more share of CHEAP
    assert detail["CHEAP"].shares_purchased == 10_001
    summary = portfolio_summary(bars_from_prices(spark, prices)).collect()[0]
    assert summary.total_capital_invested <= 20_000.0 + 0.01
    assert summary.residual_cash == 0.0


def test_mixed_prices_against_sequential(spark):
    prices = {"A": (37.5, 50.0), "B": (123.45, 130.0)}
    want, pool = sequential(prices)
    got = {r.symbol: r.shares_purchased for r in portfolio_detail(bars_from_prices(spark, prices)).collect()}
    assert got == want
    s = portfolio_summary(bars_from_prices(spark, prices)).collect()[0]
    assert s.residual_cash == pytest.approx(float(pool))


def test_random_baskets_match_sequential_loop(spark):
    rnd = random.Random(3)
    baskets = []
    for b in range(40):
        n = rnd.randrange(1, 12)
        prices = {f"B{b}S{i}": (round(rnd.uniform(0.5, 15000), 2), round(rnd.uniform(0.5, 15000), 2)) for i in range(n)}
        baskets.append(prices)
    # one Spark job per basket would be slow; run them as separate symbols sets
    for prices in baskets[:12]:
        want, pool = sequential(prices)
        df = bars_from_prices(spark, prices)
        got = {r.symbol: r.shares_purchased for r in portfolio_detail(df).collect()}
        assert got == want, prices
        s = portfolio_summary(df).collect()[0]
        cheapest = min(p[0] for p in prices.values())
        assert s.residual_cash < cheapest + 1e-9
        assert s.total_capital_invested <= 10_000 * len(prices) + 0.01


def test_tie_on_cheapest_breaks_by_symbol(spark):
    prices = {"ZED": (3.0, 4.0), "ABE": (3.0, 4.0), "BIG": (7.0, 7.0)}
    got = {r.symbol: r.shares_purchased for r in portfolio_detail(bars_from_prices(spark, prices)).collect()}
    want, _ = sequential(prices)
    assert got == want and got["ABE"] > got["ZED"]


def test_empty_portfolio_summary_is_zeros(spark):
    s = portfolio_summary(make_bars(spark, [])).collect()
    assert len(s) == 1 and all(v == 0.0 for v in s[0].asDict().values())


def test_whole_shares_are_exact_for_decimal_prices(spark):
    # binary floating point floors 10000 / 0.1 to 99,999
    detail = {r.symbol: r for r in portfolio_detail(bars_from_prices(spark, {"DIME": (0.1, 0.2)})).collect()}
    assert detail["DIME"].shares_purchased == 100_000 and detail["DIME"].uninvested_cash == 0.0


def test_prices_without_a_money_value_are_left_out(spark):
    from barsmith.operators.anchors import first_last
    from barsmith.plans.portfolio import left_out

    bars = bars_from_prices(spark, {"TINY": (1e-7, 1.0), "NAN": (10.0, float("nan")), "HUGE": (1e18, 1.0), "OK": (100.0, 110.0)})
    assert [r.symbol for r in portfolio_detail(bars).collect()] == ["OK"]
    s = portfolio_summary(bars).collect()[0]
    assert (s.total_capital_invested, s.total_current_value, s.total_return_pct) == (10_000.0, 11_000.0, 10.0)
    assert {r.symbol for r in left_out(first_last(bars)).collect()} == {"TINY", "NAN", "HUGE"}
