"""Randomised cross-checks against plain-Python statements of the rules."""
from __future__ import annotations

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barsmith.functions.names import names_match
from barsmith.operators import quality
from barsmith.plans import analytics
from tests.conftest import make_bars, make_raw

# ---------------------------------------------------------------- quality gate
price = st.one_of(st.none(), st.sampled_from([0.0, 0.005, 0.01, 0.02, 1.0, 99.5, 100.0, 101.0, -3.0]))
raw_row = st.fixed_dictionaries({
    "symbol": st.sampled_from([None, "", "  ", "AAPL", "X"]),
    "date": st.sampled_from([None, "2025-01-02", "bad", "2025-13-01", "2024-02-29"]),
    "open": price, "high": price, "low": price, "close": price,
    "volume": st.sampled_from([None, -1, 0, 5]),
})


def python_reason(r):
    def ok(v):
        return v is True

    def gt(a, b):
        return None if a is None or b is None else a > b

    def ge(a, b):
        return None if a is None or b is None else a >= b

    import datetime as dt
    try:
        d = dt.date.fromisoformat(r["date"]) if r["date"] and re.fullmatch(r"\d{4}-\d{2}-\d{2}", r["date"]) else None
    except ValueError:
        d = None
    checks = [
        ("non_null_symbol", r["symbol"] is not None and r["symbol"].strip(" ") != ""),
        ("non_null_date", d is not None),
        ("non_null_close", r["close"] is not None),
        ("positive_close", gt(r["close"], 0.01)),
        ("non_null_open", r["open"] is not None),
        ("positive_open", gt(r["open"], 0.01)),
        ("high_gte_low", ge(r["high"], r["low"])),
        ("high_gte_close", ge(r["high"], r["close"])),
        ("low_lte_close", ge(r["close"], r["low"])),
        ("non_negative_volume", r["volume"] is None or r["volume"] >= 0),
    ]
    return next((n for n, c in checks if not ok(c)), None)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(raw_row, min_size=1, max_size=60))
def test_gate_matches_python_rules(spark, rows):
    rows = [dict(r, volume=(r["volume"] if r["volume"] is None else r["volume"] * 1000 + i)) for i, r in enumerate(rows)]
    flagged = quality.flag(make_raw(spark, rows))
    got = {r.volume: r.failure_reason for r in flagged.select("volume", "failure_reason").collect()
           if r.volume is not None}
    want = {r["volume"]: python_reason(r) for r in rows if r["volume"] is not None}
    assert got == want
    assert quality.valid(flagged).count() + quality.quarantine(flagged).count() == len(rows)


# ---------------------------------------------------------------- name match
# Worked by hand from the rules: lower case, marks to blanks, legal forms out,
# words of three letters or more; then no expected word, no actual word, a
# shared word, the symbol as a word.
NAMES = [
    ("", "Visa", "V", True), ("The Group Inc.", "Visa", "", True), ("3M Co", "Meta", "MMM", True),  # nothing expected
    ("Visa", "", "V", False), ("Visa", "The Company", "V", False), ("Visa", "3M Co", "3M", False),  # nothing actual
    ("Visa Inc. Class A", "VISA holdings", "", True), ("Meta Trading", "xyz TRADING ltd", "", True),  # shared
    ("Apple", "Apples", "", False), ("McDonald's", "McDonalds", "", False), ("Class  b Visa", "class b Meta", "", False),
    ("General", "GE Aerospace", "GE", True), ("General", "ge aerospace", "GE", True), ("General", "GEX Aerospace", "GE", False),
    ("Berkshire", "New BRK.B Trust", "BRK.B", True), ("Berkshire", "New BRKXB Trust", "BRK.B", False),
    ("Meta", "Other Financial", "", False), ("Meta - & Co", "& Meta", "FB", True),
]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.permutations(NAMES), st.sampled_from(["", " Ltd", ", Incorporated", " (Holdings)"]))
def test_names_match_cases_in_any_order_and_with_legal_forms(spark, cases, form):
    df = spark.createDataFrame([(i, e + form, a + form, s) for i, (e, a, s, _) in enumerate(cases)], "i int, e string, a string, s string")
    got = {r.i: r.m for r in df.select("i", names_match(F.col("e"), F.col("a"), F.col("s")).alias("m")).collect()}
    assert got == {i: c[3] for i, c in enumerate(cases)}


# ---------------------------------------------------------------- hot symbol
def test_hot_symbol_relative_increase_matches_brute_force(spark):
    import datetime as dt
    import random
    rnd = random.Random(5)
    start = dt.date(2025, 1, 1)
    rows = []
    for d in range(900):  # HOT holds a third of the bars
        rows.append(("HOT", str(start + dt.timedelta(days=d)), round(rnd.uniform(1, 100), 2)))
    for s in range(60):
        for d in sorted(rnd.sample(range(900), 30)):
            rows.append((f"S{s:02d}", str(start + dt.timedelta(days=d)), round(rnd.uniform(1, 100), 2)))
    got = {r.symbol: (r.start_price, r.end_price, r.rank) for r in analytics.relative_increase(make_bars(spark, rows)).collect()}
    by = {}
    for s, d, c in rows:
        by.setdefault(s, []).append((d, c))
    inc = {}
    for s, pts in by.items():
        pts.sort()
        inc[s] = (pts[0][1], pts[-1][1], (pts[-1][1] - pts[0][1]) / pts[0][1])
    want = {s: (a, b, 1 + sum(1 for t in inc.values() if t[2] > v)) for s, (a, b, v) in inc.items()}
    assert got == want


# ---------------------------------------------------------------- distributed rank
rank_value = st.one_of(st.none(), st.just(float("nan")), st.sampled_from([-2.5, -1.0, 0.0, 0.5, 1.0, 3.0, 7.25]))


def spark_order_key(v):
    """Spark's DESC NULLS LAST order: NaN above every number, NULL last."""
    if v is None:
        return (2, 0.0)
    if v != v:
        return (0, 0.0)
    return (1, -v)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(rank_value, min_size=1, max_size=40), st.integers(min_value=1, max_value=9))
def test_global_rank_matches_brute_force(spark, values, parts):
    from barsmith.operators.ranking import global_rank

    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, v double")
    got = {r.id: r.rank for r in global_rank(df, "v", num_partitions=parts).collect()}
    keys = [spark_order_key(v) for v in values]
    want = {i: 1 + sum(1 for k in keys if k < keys[i]) for i in range(len(values))}
    assert got == want


def test_global_rank_without_exchange_reuse(spark):
    """The ranks do not depend on Spark evaluating a sampled exchange once."""
    from pyspark.sql import Window

    from barsmith.operators.ranking import global_rank

    before = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = spark.range(300_000, numPartitions=8).selectExpr(
            "id", "case when id % 3 = 0 then 0.0D else cast(xxhash64(id) % 1000003 as double) end as v")
        got = global_rank(df, "v", num_partitions=8)
        want = df.select("id", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last())).alias("want"))
        assert got.join(want, "id").where("rank <> want").count() == 0 and got.count() == 300_000
    finally:
        spark.conf.set("spark.sql.exchange.reuse", before)
