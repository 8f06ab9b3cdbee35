from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barsmith.operators.anchors import first_last, first_last_window
from barsmith.operators.ranking import global_rank
from barsmith.plans import analytics
from barsmith.schemas import MONTHLY_CAGR, RELATIVE_INCREASE, WEEKLY_RETURNS
from tests.conftest import make_bars

MONTH_ENDS = ["2025-01-31", "2025-02-28", "2025-03-31", "2025-04-30", "2025-05-30", "2025-06-30",
              "2025-07-31", "2025-08-29", "2025-09-30", "2025-10-31", "2025-11-28", "2025-12-31"]


@pytest.fixture()
def minimal(spark):
    aapl = [100 + i * (100 / 11) for i in range(12)]
    aapl[5] = 160.0
    msft = [300 + i * (60 / 11) for i in range(12)]
    msft[5] = 350.0
    rows = [("AAPL", d, c) for d, c in zip(MONTH_ENDS, aapl)] + [("MSFT", d, c) for d, c in zip(MONTH_ENDS, msft)]
    return make_bars(spark, rows)


def test_t1_winner_and_pct(minimal):
    out = {r.symbol: r for r in analytics.relative_increase(minimal).collect()}
    assert out["AAPL"].rank == 1 and out["MSFT"].rank == 2
    assert out["AAPL"].relative_increase_pct == pytest.approx(100.0)
    assert out["MSFT"].relative_increase == pytest.approx(0.2)


def test_t1_schema(minimal):
    df = analytics.relative_increase(minimal)
    assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in RELATIVE_INCREASE]


def test_t1_single_point_kept_by_default_excluded_with_min_points(spark):
    df = make_bars(spark, [("LONE", "2025-01-02", 50.0), ("PAIR", "2025-01-02", 100.0), ("PAIR", "2025-06-30", 200.0)])
    default = {r.symbol: r for r in analytics.relative_increase(df).collect()}
    assert default["LONE"].relative_increase == 0.0 and default["PAIR"].rank == 1
    strict = [r.symbol for r in analytics.relative_increase(df, min_points=2).collect()]
    assert strict == ["PAIR"]


def test_t1_loser_below_winner_and_zero_start_excluded(spark):
    df = make_bars(spark, [("LOSER", "2025-01-02", 100.0), ("LOSER", "2025-02-03", 50.0),
                           ("WINNER", "2025-01-02", 100.0), ("WINNER", "2025-02-03", 200.0),
                           ("ZERO", "2025-01-02", 0.0), ("ZERO", "2025-02-03", 5.0)])
    out = {r.symbol: r.rank for r in analytics.relative_increase(df).collect()}
    assert out == {"WINNER": 1, "LOSER": 2}


def test_t3_cagr_and_exclusions(spark, minimal):
    out = {r.symbol: r for r in analytics.monthly_cagr(minimal).collect()}
    assert out["AAPL"].monthly_cagr == pytest.approx((160 / 100) ** (1 / 5) - 1)
    assert out["AAPL"].n_months == 5 and out["AAPL"].rank == 1
    no_jan = make_bars(spark, [("NO_JAN", "2025-02-03", 10.0), ("NO_JAN", "2025-06-30", 20.0),
                               ("HAS_JAN", "2025-01-15", 10.0), ("HAS_JAN", "2025-06-16", 20.0)])
    assert [r.symbol for r in analytics.monthly_cagr(no_jan).collect()] == ["HAS_JAN"]


def test_t3_uses_last_day_of_month_and_year_pin(spark):
    df = make_bars(spark, [("S", "2024-01-31", 50.0), ("S", "2025-01-10", 90.0), ("S", "2025-01-31", 100.0),
                           ("S", "2025-06-02", 150.0), ("S", "2025-06-30", 160.0), ("S", "2024-06-28", 70.0)])
    r = analytics.monthly_cagr(df).collect()[0]
    assert (r.start_price, r.end_price) == (100.0, 160.0)
    r24 = analytics.monthly_cagr(df, year=2024).collect()[0]
    assert (r24.start_price, r24.end_price) == (50.0, 70.0)
    assert [(f.name, f.dataType) for f in analytics.monthly_cagr(df).schema] == [(f.name, f.dataType) for f in MONTHLY_CAGR]


@pytest.fixture()
def weekly(spark):
    crash = [("2025-01-06", 100.0), ("2025-01-07", 95.0), ("2025-01-08", 90.0), ("2025-01-09", 85.0),
             ("2025-01-10", 80.0), ("2025-01-13", 81.0), ("2025-01-14", 83.0), ("2025-01-15", 84.0),
             ("2025-01-16", 86.0), ("2025-01-17", 87.0)]
    stable = [(d, 50.0 + (i % 2) * 0.5) for i, (d, _) in enumerate(crash)]
    return make_bars(spark, [("CRASH", d, c) for d, c in crash] + [("STABLE", d, c) for d, c in stable])


def test_t4_worst_week(weekly):
    rows = analytics.worst_weeks(weekly).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.symbol == "CRASH" and r.weekly_return_pct == pytest.approx(-20.0)
    assert str(r.week_start) == "2025-01-06" and str(r.week_end) == "2025-01-10" and r.week_start < r.week_end
    assert [(f.name, f.dataType) for f in analytics.worst_weeks(weekly).schema] == \
        [(f.name, f.dataType) for f in WEEKLY_RETURNS]


def test_t4_one_day_week_excluded_and_year_label(spark):
    df = make_bars(spark, [("SOLO_WEEK", "2025-01-06", 100.0), ("NORMAL", "2025-01-06", 100.0),
                           ("NORMAL", "2025-01-07", 90.0), ("NORMAL", "2025-01-08", 80.0),
                           ("EDGE", "2024-12-30", 10.0), ("EDGE", "2025-01-02", 12.0)])
    rows = {r.symbol: r for r in analytics.weekly_returns(df).collect()}
    assert "SOLO_WEEK" not in rows
    assert rows["NORMAL"].weekly_return == pytest.approx(-0.2)
    # Monday 2024-12-30: calendar year of the Monday, ISO week 1
    assert (rows["EDGE"].year, rows["EDGE"].week_of_year) == (2024, 1)


def test_first_last_forms_agree(spark):
    rnd = random.Random(7)
    rows = [(f"S{rnd.randrange(30)}", f"2025-{rnd.randrange(1, 13):02d}-{rnd.randrange(1, 29):02d}", rnd.random() * 100)
            for _ in range(3000)]
    df = make_bars(spark, rows).dropDuplicates(["symbol", "date"])
    a = first_last(df.select("symbol", "date", "close"))
    b = first_last_window(df.select("symbol", "date", "close"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("descending", [True, False])
def test_global_rank_matches_window_rank(spark, descending):
    rnd = random.Random(11)
    # heavy ties: a value held by a third of the rows, plus NaN-free doubles
    vals = [0.0 if i % 3 == 0 else float(rnd.randrange(200)) for i in range(5000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    got = global_rank(df, "v", descending=descending, num_partitions=7)
    order = F.col("v").desc() if descending else F.col("v").asc()
    want = df.withColumn("rank", F.rank().over(Window.orderBy(order)).cast("int"))
    assert got.count() == 5000
    assert got.exceptAll(want).count() == 0


def test_global_rank_brute_force_small(spark):
    vals = [3.0, 1.0, 3.0, 2.0, 5.0, 5.0, 5.0, -1.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "id long, v double")
    got = {r.id: r.rank for r in global_rank(df, "v", num_partitions=3).collect()}
    want = {i: 1 + sum(1 for w in vals if w > v) for i, v in enumerate(vals)}
    assert got == want


def test_empty_inputs_give_empty_outputs(spark):
    empty = make_bars(spark, [])
    assert analytics.relative_increase(empty).count() == 0
    assert analytics.monthly_cagr(empty).count() == 0
    assert analytics.worst_weeks(empty).count() == 0


def test_anchor_table_answers_equal_direct_answers(spark, minimal):
    anchors = analytics.symbol_anchors(minimal)
    a = analytics.relative_increase_from_anchors(anchors)
    b = analytics.relative_increase(minimal)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    c = analytics.monthly_cagr_from_anchors(anchors)
    d = analytics.monthly_cagr(minimal)
    assert c.exceptAll(d).count() == 0 and d.exceptAll(c).count() == 0


def test_ranked_tables_come_back_in_rank_order(spark):
    import random
    rnd = random.Random(9)
    rows = []
    for s in range(40):
        rows += [(f"S{s:02d}", "2025-01-31", 100.0), (f"S{s:02d}", "2025-06-30", float(rnd.randrange(50, 150)))]
    ranks = [r["rank"] for r in analytics.relative_increase(make_bars(spark, rows)).collect()]
    assert ranks == sorted(ranks) and ranks[0] == 1
    ranks = [r["rank"] for r in analytics.monthly_cagr(make_bars(spark, rows)).collect()]
    assert ranks == sorted(ranks) and ranks[0] == 1
