from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from barsmith.functions.names import names_match
from barsmith.operators import tickers
from barsmith.plans import inputs
from barsmith.schemas import TICKER_REFERENCE
from tests.conftest import SF001

NAME_CASES = [
    ("Apple Inc.", "Apple Inc.", "AAPL", True),
    ("General Electric Company", "GE Aerospace", "GE", True),
    ("Meta Platforms Inc. Class", "ProShares Dynamic Buffer ETF", "FB", False),
    ("3M Company", "Anything", "MMM", True),
    ("Anthem Inc.", "FB Inc", "FB", False),
    ("Meta", "FB Financial", "FB", True),
    ("McDonald’s Corporation", "McDonalds Corp", "MCD", False),
    ("Visa Inc. Class A", "VISA INC", "V", True),
    ("Berkshire Hathaway Inc. Class B", "Berkshire Hathaway", "BRK.B", True),
    ("Some Name", "BRKXB Holdings Trust", "BRK.B", False),
]


def test_name_match_cases(spark):
    df = spark.createDataFrame([c[:3] for c in NAME_CASES], "e string, a string, s string")
    got = [r.m for r in df.select(names_match(F.col("e"), F.col("a"), F.col("s")).alias("m")).collect()]
    assert got == [c[3] for c in NAME_CASES]


def vet(spark, listing, reference):
    companies = spark.createDataFrame([(i, n, s) for i, (n, s) in enumerate(listing)],
                                      "position bigint, company_name string, symbol string")
    ref = spark.createDataFrame(reference, TICKER_REFERENCE)
    return {r.position: r for r in tickers.vet_tickers(companies, ref).collect()}


def test_precedence_blank_duplicate_format(spark):
    out = vet(spark, [("A", " aapl "), ("A", "AAPL"), ("B", ""), ("C", None), ("D", "TOOLONG"), ("E", "TOOLONG"),
                      ("F", "BRK.B")], [])
    assert out[0].outcome == "valid" and out[0].symbol == "AAPL" and "unreachable" in out[0].warning
    assert out[1].outcome == "duplicate" and out[1].warning == "Duplicate symbol: AAPL"
    assert out[2].reason == "Empty symbol" and out[3].reason == "Empty symbol"
    assert out[4].outcome == "invalid" and out[4].reason.startswith("Invalid format 'TOOLONG'")
    assert out[5].outcome == "duplicate"
    assert out[6].outcome == "valid"


def test_lookup_outcomes(spark):
    import datetime as dt
    d = dt.date(2024, 1, 1)
    ref = [("NF", 404, True, "CS", "X", d), ("PERM", 403, True, "CS", "X", d), ("BOOM", 500, None, None, None, d),
           ("RATE", 429, None, None, None, d), ("GONE", 200, False, "CS", "Gone Co", d), ("ETF", 200, True, "ETF", "Fund", d),
           ("NOTY", 200, True, None, "Notype Inc", d), ("EMPTY", 200, None, None, None, d),
           ("MISM", 200, True, "CS", "Other Thing", d), ("OK", 200, True, "cs", "Okay Industries", d)]
    listing = [("N", "NF"), ("P", "PERM"), ("B", "BOOM"), ("R", "RATE"), ("G", "GONE"), ("E", "ETF"),
               ("Notype", "NOTY"), ("Em", "EMPTY"), ("Expected Name", "MISM"), ("Okay Industries Inc", "OK")]
    out = {r.symbol: r for r in vet(spark, listing, ref).values()}
    assert out["NF"].outcome == "invalid" and "not found" in out["NF"].reason
    assert out["PERM"].outcome == "valid" and out["PERM"].warning == "Could not verify (API permission issue)"
    assert out["BOOM"].warning == "API returned 500" and out["RATE"].warning == "API returned 429"
    assert out["GONE"].reason == "Ticker is inactive/delisted (was: 'Gone Co')"
    assert out["ETF"].reason == "'Fund' is not a stock (Polygon type: 'ETF')"
    assert out["NOTY"].outcome == "valid"
    assert out["EMPTY"].reason == "No reference data returned by Polygon"
    assert out["MISM"].outcome == "invalid" and out["MISM"].reason.startswith("Company name mismatch")
    assert out["OK"].outcome == "valid" and out["OK"].matched_name == "Okay Industries"


def test_as_of_picks_latest_record_before_date(spark):
    import datetime as dt
    ref = [("ABC", 200, True, "CS", "Old Name Co", dt.date(2020, 1, 1)),
           ("ABC", 200, False, "CS", "Old Name Co", dt.date(2026, 1, 1))]
    companies = spark.createDataFrame([(0, "Old Name", "ABC")], "position bigint, company_name string, symbol string")
    r = spark.createDataFrame(ref, TICKER_REFERENCE)
    assert tickers.vet_tickers(companies, r, as_of="2025-01-01").collect()[0].outcome == "valid"
    assert tickers.vet_tickers(companies, r, as_of="2026-06-01").collect()[0].outcome == "invalid"


def test_supplier_fixture_outcome_counts(spark):
    v = tickers.vet_tickers(inputs.company_list(spark, SF001), inputs.ticker_reference(spark, SF001), as_of="1997-01-01")
    rows = v.collect()
    ok = sum(1 for r in rows if r.outcome == "valid" and r.warning is None)
    warned = sum(1 for r in rows if r.outcome == "valid" and r.warning is not None)
    rejected = sum(1 for r in rows if r.outcome == "invalid")
    assert (ok, warned, rejected) == (42, 20, 38)
    rep = tickers.report(v).collect()[0]
    assert (rep.total, rep.valid, rep.invalid, rep.warnings) == (100, 62, 38, 20)


@pytest.mark.parametrize("n", [3000])
def test_hot_duplicate_symbol(spark, n):
    companies = spark.createDataFrame([(i, "Hot Co", "HOT" if i % 3 else f"S{i}") for i in range(n)],
                                      "position bigint, company_name string, symbol string")
    dup = tickers.duplicates(companies).collect()
    assert len(dup) == 1 and dup[0].symbol == "HOT" and dup[0].first_position == 1
    v = tickers.vet_tickers(companies, spark.createDataFrame([], TICKER_REFERENCE))
    assert v.where("outcome = 'duplicate'").count() == dup[0].n - 1


def test_verdicts_come_back_in_input_order(spark):
    v = tickers.vet_tickers(inputs.listings(spark, SF001), inputs.ticker_reference(spark, SF001))
    positions = [r.position for r in v.select("position").collect()]
    assert positions == sorted(positions) and len(positions) == 110


def test_symbol_with_quote_terminator_is_literal(spark):
    from barsmith.functions.names import symbol_word_in
    df = spark.createDataFrame([("X\\E.Y Corp", "X\\E.Y"), ("XAEZY Corp", "X\\E.Y"), ("GE Aerospace", "ge")],
                               "t string, s string")
    got = [r.m for r in df.select(symbol_word_in(F.col("t"), F.col("s")).alias("m")).collect()]
    assert got == [True, False, True]
