"""Bar tables derived from the TPC-H-style driver tables.

Suppliers play tickers and their shipped line items play trades:
one bar per (supplier, ship day).  Everything is an aggregate over the whole
``lineitem`` table, so the work grows with it.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.functions.dates import date_to_epoch_ms
from barsmith.functions.keys import packed_key

# Fixed value: ingest stamp used for derived bars so results are reproducible.
DERIVED_INGESTED_AT = "2026-01-05 00:00:00"

BAR_COLUMNS = ("symbol", "date", "open", "high", "low", "close", "volume", "transactions")


# The derived inputs are written as SQL expressions (as FIXTURES.md states
# them): one expression per column keeps plan construction cheap.
# Symbols count on in the accepted ticker format, so no two keys share one: three
# letters, then four, five, five with a class letter, five with two; keys past
# those (8.4 billion) get their base-36 digits, which no shorter form equals.
SYMBOL_WIDTHS = (3, 4, 5, 6, 7)


def symbol_of(k: str) -> str:
    """SQL text: the symbol of a non-negative integer key.  Digits of base 26
    become letters; one short expression, as plans evaluate it in several places
    and methods past the JIT's size limit run interpreted."""
    bounds, belows, widths = 0, [], []
    for w in SYMBOL_WIDTHS:
        belows.append(f"when {k} < {bounds + 26 ** w} then {bounds}L")
        widths.append(f"when {k} < {bounds + 26 ** w} then {w}")
        bounds += 26 ** w
    digits = "0123456789ABCDEFGHIJKLMNOP"
    letters = (f"lpad(translate(conv({k} - case {' '.join(belows)} end, 10, 26), '{digits}', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ'), "
               f"case {' '.join(widths)} end, 'A')")
    first = SYMBOL_WIDTHS[0] + 2
    short = sum(26 ** w for w in SYMBOL_WIDTHS if w <= first)
    return (f"case when {k} < {short} then {letters} when {k} < {bounds} then concat(left({letters}, {first}), '.', substr({letters}, {first + 1})) "
            f"else conv({k}, 10, 36) end")


def key_of(symbol: str) -> int | None:
    """The key that :func:`symbol_of` gives this symbol; None if none does."""
    letters = symbol.replace(".", "", 1) if len(symbol) > 5 and symbol[5] == "." else symbol
    if len(letters) in SYMBOL_WIDTHS and all("A" <= c <= "Z" for c in letters) and ((len(letters) > 5) == ("." in symbol)):
        below = sum(26 ** w for w in SYMBOL_WIDTHS if w < len(letters))
        return below + sum((ord(c) - 65) * 26 ** i for i, c in enumerate(reversed(letters)))
    first = sum(26 ** w for w in SYMBOL_WIDTHS)
    try:
        key = int(symbol, 36)
    except ValueError:
        return None
    return key if key >= first and symbol == symbol.upper() else None


#: the trades of a day come by order, line and part; what is equal in these by price in cents
TRADE_ORDER = (("l_orderkey", 44), ("l_linenumber", 8), ("l_partkey", 40), ("cents", 34))


def trade_prices(lineitem: DataFrame) -> DataFrame:
    """Unit price per line item, floored to cents (floor, not round: the two
    engines round doubles differently at ties).  A row without a positive
    quantity has no price and no place in the order of trades; a bar made of
    such rows alone has NULL prices and ends in quarantine.  The order is a
    key of fixed width; trades that tie in it have equal prices."""
    cents = "case when l_quantity > 0 then floor(l_extendedprice * 100 / l_quantity) end as cents"
    return lineitem.selectExpr("l_suppkey as key", "to_date(l_shipdate) as date", "l_quantity", "l_orderkey", "l_linenumber", "l_partkey", cents).selectExpr(
        "key", "date", "l_quantity", "cents / 100 as p", f"{packed_key(TRADE_ORDER)} as k")


def bars_from_lineitem(lineitem: DataFrame, ingested_at: str = DERIVED_INGESTED_AT) -> DataFrame:
    """Daily OHLCV bars in the VALIDATED layout (date typed)."""
    return bars_from_trades(trade_prices(lineitem), ingested_at)


def bars_from_trades(trades: DataFrame, ingested_at: str = DERIVED_INGESTED_AT) -> DataFrame:
    """:func:`bars_from_lineitem` over :func:`trade_prices` rows.  Trades are
    grouped by key and a group is named afterwards, as no two keys share a symbol."""
    return trades.groupBy("key", "date").agg(
        F.expr("min_by(p, k)").alias("open"),
        F.expr("max(p)").alias("high"),
        F.expr("min(p)").alias("low"),
        F.expr("max_by(p, k)").alias("close"),
        F.expr("cast(sum(l_quantity) as bigint)").alias("volume"),
        F.expr("count(1)").alias("transactions"),
    ).selectExpr(f"{symbol_of('key')} as symbol", "date", "open", "high", "low", "close", "volume", "cast(null as double) as vwap",
                 "transactions", f"timestamp'{ingested_at}' as ingested_at")


def raw_bars_from_bars(bars: DataFrame) -> DataFrame:
    """RAW layer (date as text) with planted faults, one per rule family:
    missing symbols, unparsable dates, missing open/high/close, high below low, zero close and
    negative volume.  Every bar is kept; faults are a deterministic function
    of the bar's own values."""
    return bars.selectExpr(
        "case when volume % 53 = 0 then null else symbol end as symbol",
        "case when (dayofmonth(date) + transactions) % 29 = 0 then 'bad-date'"
        " else date_format(date, 'yyyy-MM-dd') end as date",
        "case when volume % 31 = 0 then null when volume % 59 = 0 then 0.0D else open end as open",
        "case when volume % 37 = 0 then null when volume % 41 = 0 then low - 1 else high end as high",
        "low",
        "case when volume % 43 = 0 then null when volume % 47 = 0 then 0.0D"
        " when volume % 61 = 0 then high * 2 when volume % 67 = 0 then low * 0.5D else close end as close",
        "case when volume % 23 = 0 then -volume else volume end as volume",
        "vwap",
        "transactions",
        "ingested_at",
    )


def company_list_from_supplier(supplier: DataFrame) -> DataFrame:
    """Company list with an input position: one company per supplier."""
    return supplier.selectExpr(
        "s_suppkey as position",
        "concat(s_name, ' Inc.') as company_name",
        symbol_of("s_suppkey") + " as symbol",
    )


def ticker_reference_from_supplier(supplier: DataFrame, as_of: str = "1995-01-01") -> DataFrame:
    """Reference records of every supplier ticker covering every lookup
    outcome: not found, permission, server error, no answer, rate limited,
    redirected, inactive, non-stock types, missing type, empty record,
    renamed-with-symbol, unrelated name and a name that reduces to nothing.
    Two more records, five years earlier and forty later, say otherwise."""
    sym, k = symbol_of("s_suppkey"), "s_suppkey"
    current = supplier.selectExpr(
        f"{sym} as symbol",
        f"cast(case {k} % 20 when 0 then 404 when 1 then 403 when 2 then 500 when 3 then null"
        " when 4 then 429 when 5 then 301 else 200 end as int) as http_status",
        f"case when {k} % 23 = 0 then null else {k} % 11 <> 0 end as active",
        f"case when {k} % 23 = 0 then null when {k} % 13 = 0 then 'ETF' when {k} % 17 = 0 then null else 'cs' end as type",
        f"case when {k} % 23 = 0 then null when {k} % 21 = 0 then concat({sym}, ' Aerospace')"
        f" when {k} % 7 = 0 then 'Unrelated Trading Corp'"
        f" when {k} % 9 = 0 then 'The Group Inc' else s_name end as name",
        f"date'{as_of}' as as_of",
    )
    older = current.selectExpr("symbol", "500 as http_status", "active", "type", "name", "add_months(as_of, -60) as as_of")
    newer = current.selectExpr("symbol", "404 as http_status", "active", "type", "name", "add_months(as_of, 480) as as_of")
    return older.unionByName(current).unionByName(newer)


# Planted envelope faults, chosen by the symbol's last letter.
ERROR_ENVELOPE_LETTER = "C"  # status ERROR with a message
NOT_JSON_LETTER = "D"  # the landed line is not JSON at all
NO_RESULTS_LETTER = "E"  # status OK but ``results`` missing
DELAYED_LETTER = "F"  # status DELAYED, with bars
NEVER_LANDED_LETTER = "G"  # no response at all
RECORD_LETTERS = ("D", "H")  # landed as a record of request and body


def payload_lines_from_bars(bars: DataFrame, never_landed: str | None = NEVER_LANDED_LETTER) -> DataFrame:
    """Landed response lines (column ``value``): one envelope per
    (symbol, calendar month), so an envelope never holds more than 31 bars
    whatever the size of a symbol's history.  Some bars lack the time, the open
    or the volume, and some have a zero ``vw`` or ``n`` (by their volume).  Symbols
    that end in ``never_landed`` have no response; with None all symbols have."""
    month = F.date_trunc("month", F.col("date"))
    bar = F.struct(
        F.when(F.expr("volume % 71 <> 0"), date_to_epoch_ms(F.col("date"))).alias("t"),
        F.expr("case when volume % 73 <> 0 then open end").alias("o"),
        F.col("high").alias("h"), F.col("low").alias("l"), F.col("close").alias("c"),
        F.expr("case when volume % 79 <> 0 then volume end").alias("v"),
        F.expr("case volume % 3 when 0 then 0.0D when 1 then close end").alias("vw"),
        F.expr("case when volume % 83 = 0 then 0 else transactions end").alias("n"),
    )
    grouped = bars.groupBy("symbol", month.alias("_month")).agg(F.array_sort(F.collect_list(bar)).alias("results"))
    last = F.substring("symbol", -1, 1)
    ok = F.to_json(F.struct(F.col("symbol").alias("ticker"), F.when(last == DELAYED_LETTER, "DELAYED").otherwise("OK").alias("status"),
                            F.size("results").cast("long").alias("resultsCount"), "results"))
    body = (F.when(last == ERROR_ENVELOPE_LETTER,
                   F.to_json(F.struct(F.col("symbol").alias("ticker"), F.lit("ERROR").alias("status"),
                                      F.lit("Unknown API Key").alias("error"))))
            .when(last == NOT_JSON_LETTER, F.lit("<html>504 Gateway Time-out</html>"))
            .when(last == NO_RESULTS_LETTER,
                  F.to_json(F.struct(F.col("symbol").alias("ticker"), F.lit("OK").alias("status"),
                                     F.lit(0).cast("long").alias("resultsCount"))))
            .otherwise(ok))
    record = F.to_json(F.struct(F.col("symbol").alias("requested"), body.alias("body")))
    landed = grouped.where(last.isNotNull() if never_landed is None else last != never_landed)
    return landed.select(F.when(last.isin(*RECORD_LETTERS), record).otherwise(body).alias("value"))


def reference_history_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """A reference record a (supplier, ship month), known from a day in that
    month on that depends on both, with a status that changes over time."""
    months = lineitem.selectExpr("l_suppkey as k", "trunc(to_date(l_shipdate), 'month') as m").distinct()
    return months.selectExpr(
        f"{symbol_of('k')} as symbol", "date_add(m, cast((k * 7 + month(m) * 5) % 28 as int)) as as_of",
        "cast(case (k + year(m) * 12 + month(m)) % 9 when 0 then 404 when 1 then null when 2 then 403 else 200 end as int) as http_status",
        "case when (k + month(m)) % 5 = 0 then 'ETF' else 'CS' end as type")


# Hand-made listing rows for the format / blank / duplicate
# paths that supplier-derived symbols never reach: (company_name, symbol).
EDGE_LISTINGS = (
    ("Apple Inc.", " aapl "),
    ("Apple Inc.", "AAPL"),
    ("Berkshire Hathaway Inc. Class B", "BRK.B"),
    ("Too Long Corp", "TOOLONG"),
    ("Numbers Inc", "123"),
    ("Blank Co", ""),
    ("Null Co", None),
    ("Bad Class Inc", "A.BCD"),
    ("Tab Inc", "\tTABS \n"),
    ("Apple Computer", "AAPL"),
)
EDGE_POSITION_BASE = 1_000_000_000_000


def with_edge_listings(companies: DataFrame) -> DataFrame:
    """Append :data:`EDGE_LISTINGS` after every supplier row."""
    spark = companies.sparkSession
    edges = spark.createDataFrame(
        [(EDGE_POSITION_BASE + i, n, s) for i, (n, s) in enumerate(EDGE_LISTINGS)],
        "position bigint, company_name string, symbol string",
    )
    return companies.unionByName(edges)
