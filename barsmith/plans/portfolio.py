"""T2: equal-budget whole-share portfolio with the leftover cash redeployed.

Every symbol gets ``budget`` and buys ``floor(budget / start_price)`` shares.
The remainders form one pool that buys extra shares cheapest-first.  After the
cheapest symbol takes ``floor(pool / price)`` shares the pool is below its
price, hence below every other price, so only the cheapest symbol ever gets
extra shares.  That closed form replaces a driver-side loop: the pool is
one global aggregate and the cheapest symbol the first in order, each read back as
a scalar subquery (one value, no collect, no join), and every row is then priced
independently.

Money is DECIMAL(20,6) and whole-share counts use exact integral division
(``div``), so ``floor`` can never be pushed over an integer by rounding.
Greedy cheapest-first does not maximise the capital deployed in general
(pool 5, prices 3 and 5); it is the rule being reproduced, not an optimiser.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.operators.anchors import first_last

MONEY = "decimal(20,6)"
DEFAULT_BUDGET = 10_000.0


def _idiv(a: Column, b: Column) -> Column:
    """Exact integral quotient ``a div b`` (truncated; operands are positive)."""
    return F.call_function("div", a, b)


def money(price: str) -> Column:
    """The price in exact money; NULL for NaN and what the type cannot hold."""
    return F.col(price).try_cast(MONEY)


def can_be_bought() -> Column:
    """The prices have a value in money and the first is above zero there too
    (a price below a millionth has none)."""
    return F.coalesce(money("start_price") > 0, F.lit(False)) & money("end_price").isNotNull()


def left_out(anchors: DataFrame) -> DataFrame:
    """The symbols that :func:`allocation_from_anchors` cannot buy."""
    return anchors.select("symbol", "start_price", "end_price").where(~can_be_bought())


def allocation(bars: DataFrame, budget: float = DEFAULT_BUDGET) -> DataFrame:
    """Per symbol, decimal money: start/end price, shares, capital, own
    uninvested remainder, current value, pnl, plus the run's pool columns."""
    return allocation_from_anchors(first_last(bars.select("symbol", "date", "close")), budget)


def allocation_from_anchors(anchors: DataFrame, budget: float = DEFAULT_BUDGET) -> DataFrame:
    """:func:`allocation` over per-symbol ``symbol, start_price, end_price``."""
    anchors = anchors.select("symbol", "start_price", "end_price").where(can_be_bought())
    b = F.lit(str(budget)).cast(MONEY)
    sp = money("start_price")
    base = anchors.select(
        "symbol",
        "start_price",
        "end_price",
        sp.alias("_sp"),
        money("end_price").alias("_ep"),
        _idiv(b, sp).alias("_base"),
    ).withColumn("_rem", b - F.col("_base") * F.col("_sp"))

    # one global row -> scalar subquery: the pool; a second one: the cheapest (price,
    # symbol), the first in order, as a text is no buffer of a hash aggregate
    # (``max_end`` keeps the subquery's per-symbol aggregate identical to the
    # main one, so Spark reuses that exchange instead of recomputing it)
    run = base.agg(
        F.struct(
            F.sum("_rem").alias("pool"),
            F.max("_ep").alias("max_end"),
        )
    ).scalar()
    pool = run.getField("pool")
    cheapest = base.orderBy("_sp", "symbol").limit(1).select("symbol").scalar()

    is_cheapest = F.col("symbol") == cheapest
    extra = F.when(is_cheapest, _idiv(pool, F.col("_sp"))).otherwise(F.lit(0)).cast("long")
    out = base.withColumn("_extra", extra).withColumn("shares_purchased", (F.col("_base") + F.col("_extra")).cast("long"))
    return out.select(
        "symbol",
        "start_price",
        "end_price",
        "shares_purchased",
        (F.col("shares_purchased") * F.col("_sp")).cast(MONEY).alias("capital_invested"),
        # the row's own remainder, reduced (and clamped at 0) only on the cheapest row
        F.greatest(F.col("_rem") - F.col("_extra") * F.col("_sp"), F.lit(0).cast(MONEY)).cast(MONEY).alias("uninvested_cash"),
        F.round(F.col("shares_purchased") * F.col("_ep"), 4).cast(MONEY).alias("current_value"),
        pool.cast(MONEY).alias("pool"),
        (pool - F.col("_extra") * F.col("_sp")).cast(MONEY).alias("_residual_if_cheapest"),
        is_cheapest.alias("is_cheapest"),
    ).withColumn("pnl", F.round(F.col("current_value") - F.col("capital_invested"), 4).cast(MONEY))


DETAIL_COLUMNS = ("symbol", "start_price", "end_price", "shares_purchased",
                  "capital_invested", "uninvested_cash", "current_value", "pnl")


def portfolio_detail(bars: DataFrame, budget: float = DEFAULT_BUDGET) -> DataFrame:
    return detail_from_allocation(allocation(bars, budget))


def detail_from_allocation(alloc: DataFrame) -> DataFrame:
    """Detail rows (money as double, the published schema)."""
    return alloc.select(*[F.col(c).cast("double").alias(c) if c in
                          ("capital_invested", "uninvested_cash", "current_value", "pnl") else F.col(c)
                          for c in DETAIL_COLUMNS])


def portfolio_summary(bars: DataFrame, budget: float = DEFAULT_BUDGET) -> DataFrame:
    """One row: totals (2 dp), return percent (4 dp, 0 when nothing was
    invested) and ``residual_cash``, the pool actually left after the extra
    purchase (``total_uninvested_cash`` sums each row's own remainder and so
    overstates it).  Empty input gives a row of zeros."""
    return summary_from_allocation(allocation(bars, budget))


def summary_from_allocation(alloc: DataFrame) -> DataFrame:
    """One-row summary over an :func:`allocation` table."""
    zero = F.lit(0).cast(MONEY)
    sums = alloc.agg(
        F.coalesce(F.sum("capital_invested"), zero).alias("_inv"),
        F.coalesce(F.sum("uninvested_cash"), zero).alias("_cash"),
        F.coalesce(F.sum("current_value"), zero).alias("_val"),
        F.coalesce(F.sum("pnl"), zero).alias("_pnl"),
        F.coalesce(F.max(F.when(F.col("is_cheapest"), F.col("_residual_if_cheapest"))), zero).alias("_resid"),
    )
    inv, val = F.col("_inv").cast("double"), F.col("_val").cast("double")
    return sums.select(
        F.round("_inv", 2).cast("double").alias("total_capital_invested"),
        F.round("_cash", 2).cast("double").alias("total_uninvested_cash"),
        F.round("_val", 2).cast("double").alias("total_current_value"),
        F.round("_pnl", 2).cast("double").alias("total_pnl"),
        F.when(inv == 0, F.lit(0.0)).otherwise(F.round((val - inv) / inv * 100, 4)).alias("total_return_pct"),
        F.round("_resid", 2).cast("double").alias("residual_cash"),
    )
