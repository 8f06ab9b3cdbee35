from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from barsmith.plans import inputs
from barsmith.sources import lineitem_bars as lb
from barsmith.sources import payloads
from barsmith.sources.bar_store import read_bars, write_bars
from barsmith.sources.company_list import read_company_list
from tests.conftest import SF0001

MS_0102 = 1735776000000  # 2025-01-02T00:00:00Z
MS_0103 = 1735862400000


def lines(spark, docs):
    return spark.createDataFrame([(d,) for d in docs], "value string")


def test_envelope_contract(spark):
    ok = json.dumps({"ticker": "aapl", "status": "OK", "results": [
        {"t": MS_0102, "o": 10.0, "h": 11.0, "l": 9.5, "c": 10.5, "v": 1000000.5, "vw": 0, "n": 0},
        {"t": MS_0103, "o": 10.5, "h": 11.5, "l": 10.0, "c": None, "v": None}]})
    err = json.dumps({"status": "ERROR", "error": "Unknown API Key"})
    empty = json.dumps({"ticker": "MSFT", "status": "OK", "results": None})
    delayed = json.dumps({"ticker": "IBM", "status": "DELAYED", "results": [{"t": MS_0102, "o": 1, "h": 2, "l": 1, "c": 2, "v": 5, "n": 3}]})
    env = payloads.parse_payload_lines(lines(spark, [ok, err, empty, "<html>not json</html>", delayed]))
    rows = sorted(payloads.bars_from_payloads(env, "2026-01-05 00:00:00").collect(), key=lambda r: (r.symbol, r.date))
    assert [(r.symbol, r.date) for r in rows] == [("AAPL", "2025-01-02"), ("AAPL", "2025-01-03"), ("IBM", "2025-01-02")]
    a, b, ibm = rows
    assert (a.volume, a.vwap, a.transactions) == (1000000, None, None)
    assert (b.close, b.volume) == (0.0, 0)
    assert (ibm.volume, ibm.transactions) == (5, 3)


def test_null_bar_elements_are_skipped(spark):
    doc = '{"ticker": "X", "status": "OK", "results": [null, {"t": %d, "c": 2.0}]}' % MS_0102
    rows = payloads.bars_from_payloads(payloads.parse_payload_lines(lines(spark, [doc])), "2026-01-05 00:00:00").collect()
    assert [(r.date, r.close) for r in rows] == [("2025-01-02", 2.0)]


def test_missing_timestamp_is_epoch_day(spark):
    env = payloads.parse_payload_lines(lines(spark, [json.dumps({"ticker": "X", "status": "OK", "results": [{"c": 1.0}]})]))
    assert payloads.bars_from_payloads(env, "2026-01-05 00:00:00").collect()[0].date == "1970-01-01"


def test_json_round_trip_equals_bars(spark):
    bars = inputs.bars(spark, SF0001)
    back = inputs.landed_bars(spark, SF0001)
    kept = bars.where(~bars.symbol.substr(3, 1).isin("C", "D", "E", "G"))
    expect = kept.selectExpr(
        "symbol", "case when volume % 71 = 0 then '1970-01-01' else date_format(date, 'yyyy-MM-dd') end as date",
        "case when volume % 73 = 0 then 0.0D else open end as open", "high", "low", "close",
        "case when volume % 79 = 0 then 0 else volume end as volume", "case when volume % 3 = 1 then close end as vwap",
        "case when volume % 83 = 0 then null else transactions end as transactions")
    got = back.drop("ingested_at")
    assert expect.exceptAll(got).count() == 0 and got.exceptAll(expect).count() == 0


@pytest.mark.parametrize("key", ["bars_from_json", "bars_per_symbol"])
def test_every_symbol_that_answered_is_scanned(spark, key):
    """No symbol is left out before its envelope is read."""
    import __spark_entry__ as entry

    want = inputs.bars(spark, SF0001).where("right(symbol, 1) not in ('C', 'D', 'E')").groupBy("symbol").count().collect()
    got = entry.queries()[key](spark, SF0001)
    got = got.groupBy("symbol").count() if key == "bars_from_json" else got
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want} and any(r.symbol.endswith("G") for r in want)


def test_landed_files_scan_and_failures(spark, scratch):
    path = os.path.join(scratch, "landing")
    lb.payload_lines_from_bars(inputs.bars(spark, SF0001)).write.text(path)
    raw = payloads.bars_from_payloads(payloads.read_payload_files(spark, path), "2026-01-05 00:00:00")
    assert raw.count() == inputs.landed_bars(spark, SF0001).count()
    failed = payloads.fetch_failures(inputs.company_list(spark, SF0001), payloads.read_payload_files(spark, path)).collect()
    assert {r.symbol[-1]: r.reason for r in failed} == {
        "C": "status ERROR: Unknown API Key", "D": "not an envelope: <html>504 Gateway Time-out</html>", "E": "no results", "G": "never landed"}
    assert all((r.n_responses == 0) == (r.reason == "never landed") for r in failed)


def test_reasons_of_failed_fetches(spark):
    """One reason a symbol; a symbol with any bar did not fail."""
    bar = '{"ticker": "%s", "status": "OK", "results": [{"t": 1, "c": 2.0}]}'
    record = lambda s, b: json.dumps({"requested": s, "body": b})
    landed = [bar % "GOOD", '{"ticker": "GOOD", "status": "ERROR", "error": "once"}', record(" wrapd ", bar % "wrapd"),
              record("BOTH", "<oops>"), '{"ticker": "both", "status": "ERROR", "error": "later"}', '{"ticker": "BOTH", "status": "NOT_AUTHORIZED"}',
              record("TEXT", "x" * 200), '{"ticker": "NULLS", "status": "OK", "results": [null]}', '{"ticker": "NOST"}', "not json, no symbol", "", '{"requested": "CUT', None]
    parsed = payloads.parse_payload_lines(lines(spark, landed))
    asked = spark.createDataFrame([(s,) for s in ("good", "WRAPD", "BOTH", "TEXT", "NULLS", "NOST", "GONE", "GONE ", "", None)], "symbol string")
    got = {r.symbol: (r.n_responses, r.reason) for r in payloads.fetch_failures(asked, parsed).collect()}
    assert got == {"BOTH": (3, "status ERROR: later"), "TEXT": (1, "not an envelope: " + "x" * payloads.QUOTED), "NULLS": (1, "no results"),
                   "NOST": (1, "status missing"), "GONE": (0, "never landed")}
    corrupt = sorted((str(r.symbol), r.body) for r in payloads.corrupt_responses(parsed).collect())
    assert corrupt == sorted([("BOTH", "<oops>"), ("TEXT", "x" * 200), ("None", "not json, no symbol"), ("None", '{"requested": "CUT')])
    assert sorted(r.symbol for r in payloads.bars_from_payloads(parsed, "2026-01-05 00:00:00").collect()) == ["GOOD", "WRAPD"]


def test_partitioned_store_round_trip_keeps_string_symbols(spark, scratch):
    raw = inputs.raw_bars(spark, SF0001)
    path = os.path.join(scratch, "raw")
    write_bars(raw, path)
    back = read_bars(spark, path)
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0
    # a store whose only symbol looks like a number still reads back as text
    lone = spark.createDataFrame([r for r in raw.limit(3).collect()], raw.schema).selectExpr(
        "'1E5' as symbol", *[c for c in raw.columns if c != "symbol"])
    p2 = os.path.join(scratch, "lone")
    write_bars(lone, p2, partition_by=("symbol",))
    assert dict(read_bars(spark, p2).dtypes)["symbol"] == "string"
    assert {r.symbol for r in read_bars(spark, p2).collect()} == {"1E5"}
    # month layout: folders per month, pruning by month bounds
    assert any(n.startswith("month=") for n in os.listdir(path))
    p3 = os.path.join(scratch, "by-symbol")
    write_bars(raw.where("symbol is not null"), p3, partition_by=("symbol",))
    for store, rows in ((path, raw), (p3, raw.where("symbol is not null"))):
        jan97 = read_bars(spark, store, month_from="1997-01", month_to="1997-01")
        assert jan97.where("date <> 'bad-date'").count() == rows.where("date like '1997-01-%'").count() > 0
        # a bar without a month is in no folder that the bounds could rule out
        assert jan97.where("date = 'bad-date'").count() == rows.where("date = 'bad-date'").count() > 0
    plan = read_bars(spark, path, month_from="1997-01")._jdf.queryExecution().executedPlan().toString()
    assert "1997-01" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_inspect_returns_every_bar_from_both_layouts(spark, scratch):
    import datetime as dt

    from barsmith.operators.bars import inspect_symbol
    from tests.conftest import make_raw

    days = [str(dt.date(2025, 1, 1) + dt.timedelta(days=i)) for i in range(252)]
    raw = make_raw(spark, [{"symbol": "AAB", "date": d} for d in days] + [{"symbol": "ZZZ", "date": d} for d in days[:9]])
    for layout in (("month",), ("symbol",)):
        path = os.path.join(scratch, "-".join(layout))
        write_bars(raw, path, partition_by=layout)
        stored = read_bars(spark, path, month_from="2025-01", month_to="2025-12")
        assert [r.date for r in inspect_symbol(stored, "AAB", "2025-01-01", "2025-12-31").collect()] == days


def test_float_timestamp(spark):
    doc = '{"ticker": "X", "status": "OK", "results": [{"t": %d.0, "c": 2.0}]}' % MS_0103
    rows = payloads.bars_from_payloads(payloads.parse_payload_lines(lines(spark, [doc])), "2026-01-05 00:00:00").collect()
    assert [r.date for r in rows] == ["2025-01-03"]


def test_symbols_are_injective_and_well_formed(spark):
    keys = spark.range(0, 12_000_000, 1, 16).selectExpr("id", lb.symbol_of("id") + " as s")
    assert keys.select("s").distinct().count() == 12_000_000
    edge = [17_575, 17_576, 474_551, 474_552, 12_355_927, 12_355_928, 321_271_703, 321_271_704, 8_353_081_879]
    df = spark.createDataFrame([(k,) for k in edge], "id long").selectExpr(lb.symbol_of("id") + " as s")
    got = [r.s for r in df.collect()]
    assert got == ["ZZZ", "AAAA", "ZZZZ", "AAAAA", "ZZZZZ", "AAAAA.A", "ZZZZZ.Z", "AAAAA.AA", "ZZZZZ.ZZ"]


def test_key_of_a_symbol():
    edge = {0: "AAA", 1: "AAB", 17_575: "ZZZ", 17_576: "AAAA", 474_552: "AAAAA", 12_355_928: "AAAAA.A", 321_271_704: "AAAAA.AA", 8_353_081_879: "ZZZZZ.ZZ"}
    assert {k: lb.key_of(s) for k, s in edge.items()} == {k: k for k in edge}
    assert [lb.key_of(s) for s in ("", "AA", "aab", "AAAAAA", "A.A", "AAAAA.AAA", "A B", "3V55555")] == [None] * 7 + [int("3V55555", 36)]
    assert lb.key_of("0") is None and lb.key_of("3v55555") is None


def test_packed_keys_order_like_structs(spark):
    import itertools
    import random

    from barsmith.functions.keys import packed_key
    rnd = random.Random(1)
    edges = [[0, 1, (1 << b) - 1, rnd.getrandbits(b)] for b in (44, 8, 40, 34)]
    data = [x for x in itertools.product(*edges)]
    df = spark.createDataFrame(data, "a long, b int, c long, d long")
    rows_ = df.selectExpr("struct(a, b, c, d) as s", packed_key([("a", 44), ("b", 8), ("c", 40), ("d", 34)]) + " as k").collect()
    assert dict(df.selectExpr(packed_key([("a", 44), ("b", 8), ("c", 40), ("d", 34)]) + " as k").dtypes)["k"] == "decimal(38,0)"
    assert [tuple(r.s) for r in sorted(rows_, key=lambda r: r.k)] == sorted(data) and len({r.k for r in rows_}) == len(set(data))
    null = spark.createDataFrame([(None, 1)], "a long, b long").selectExpr(packed_key([("a", 60), ("b", 60)]) + " as k").collect()
    assert null[0].k is None
    for bad in (-1, 16):
        with pytest.raises(Exception, match="does not fit"):
            spark.createDataFrame([(1, bad)], "a long, b long").selectExpr(packed_key([("a", 60), ("b", 4)]) + " as k").collect()
    with pytest.raises(ValueError):
        packed_key([("a", 64), ("b", 64)])


def test_trades_without_a_quantity_reach_quarantine(spark):
    from barsmith.operators import quality

    rows = [(1, 1, 1, 0, None, 10.0), (1, 2, 1, 0, 0.0, 10.0), (2, 1, 1, 1, 2.0, 10.0), (3, 11, 1, 1, None, 9.0)]
    items = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double"
                                  ).selectExpr("*", "timestamp'2025-01-02' as l_shipdate")
    bars = {r.symbol: r for r in lb.bars_from_lineitem(items).collect()}
    assert (bars["AAA"].open, bars["AAA"].transactions) == (None, 2) and (bars["AAB"].open, bars["AAB"].transactions) == (5.0, 2)
    flagged = quality.flag(lb.bars_from_lineitem(items).withColumn("date", F.col("date").cast("string")))
    assert {r.symbol: r.failure_reason for r in flagged.collect()} == {"AAA": "non_null_close", "AAB": None}


def test_company_csv_header_is_positional(spark, scratch):
    p = os.path.join(scratch, "c.csv")
    with open(p, "w") as f:
        f.write("name,symbol\nApple Inc.,AAPL\nMicrosoft Corporation,MSFT")
    rows = read_company_list(spark, p, with_position=True).orderBy("position").collect()
    assert [(r.company_name, r.symbol) for r in rows] == [("Apple Inc.", "AAPL"), ("Microsoft Corporation", "MSFT")]
