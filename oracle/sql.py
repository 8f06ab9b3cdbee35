"""Oracle SQL per query key, written for DuckDB over the driver's views.

Shared CTEs rebuild the derived inputs (bars, raw bars, quality flags, company
list, ticker reference) from ``lineitem`` and ``supplier`` exactly as
FIXTURES.md defines them.
"""
from __future__ import annotations


def sym(k: str) -> str:
    """Letters that count on: 3, 4, 5, then 5 with a class of 1 or 2."""
    arms, below = [], 0
    for width in (3, 4, 5, 6, 7):
        letters = [f"chr(cast(65 + (({k} - {below}) // {26 ** i}) % 26 as integer))" for i in reversed(range(width))]
        text = " || ".join(letters[:5] + (["'.'"] + letters[5:] if width > 5 else []))
        arms.append(f"when {k} < {below + 26 ** width} then {text}")
        below += 26 ** width
    return f"(case {' '.join(arms)} end)"


BARS = f"""
li as (
  select {sym('l_suppkey')} as symbol, cast(l_shipdate as date) as date,
         case when l_quantity > 0 then floor(l_extendedprice * 100 / l_quantity) / 100 end as p, l_quantity,
         case when l_quantity > 0 then row(l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) end as k
  from lineitem),
bars as (
  select symbol, date, arg_min(p, k) as open, max(p) as high, min(p) as low, arg_max(p, k) as close,
         cast(sum(l_quantity) as bigint) as volume, cast(null as double) as vwap, count(*) as transactions,
         timestamp '2026-01-05 00:00:00' as ingested_at
  from li group by symbol, date)"""

RAW = BARS + """,
raw_bars as (
  select case when volume % 53 = 0 then null else symbol end as symbol,
         case when (day(date) + transactions) % 29 = 0 then 'bad-date' else strftime(date, '%Y-%m-%d') end as date,
         case when volume % 31 = 0 then null when volume % 59 = 0 then 0.0::double else open end as open,
         case when volume % 37 = 0 then null when volume % 41 = 0 then low - 1 else high end as high,
         low,
         case when volume % 43 = 0 then null when volume % 47 = 0 then 0.0::double
              when volume % 61 = 0 then high * 2 when volume % 67 = 0 then low * 0.5::double else close end as close,
         case when volume % 23 = 0 then -volume else volume end as volume,
         vwap, transactions, ingested_at
  from bars)"""

FLAGGED = RAW + """,
typed as (
  select symbol, cast(try_strptime(date, '%Y-%m-%d') as date) as date, open, high, low, close, volume, vwap,
         transactions, ingested_at, date as date_raw
  from raw_bars),
flagged as (
  select *, case
      when not coalesce(symbol is not null and trim(symbol) <> '', false) then 'non_null_symbol'
      when not coalesce(date is not null, false) then 'non_null_date'
      when not coalesce(close is not null, false) then 'non_null_close'
      when not coalesce(close > 0.01, false) then 'positive_close'
      when not coalesce(open is not null, false) then 'non_null_open'
      when not coalesce(open > 0.01, false) then 'positive_open'
      when not coalesce(high >= low, false) then 'high_gte_low'
      when not coalesce(high >= close, false) then 'high_gte_close'
      when not coalesce(low <= close, false) then 'low_lte_close'
      when not coalesce(volume is null or volume >= 0, false) then 'non_negative_volume'
      when not coalesce(cast(date as date) is not null, false) then 'date_is_valid_type'
    end as failure_reason
  from typed)"""

VALID = FLAGGED + """,
valid as (
  select symbol, date, open, high, low, close, volume, vwap, transactions, ingested_at
  from flagged where failure_reason is null)"""

T1 = VALID + """,
t1_anchor as (select symbol, arg_min(close, date) as start_price, arg_max(close, date) as end_price
              from valid group by symbol),
t1_scored as (select symbol, start_price, end_price, (end_price - start_price) / start_price as relative_increase
              from t1_anchor where start_price > 0),
t1 as (select symbol, start_price, end_price, relative_increase,
              round(relative_increase * 100, 4) as relative_increase_pct,
              cast(rank() over (order by relative_increase desc) as integer) as rank
       from t1_scored)"""

def refined_root(n: int, source: str, out: str) -> str:
    """CTEs: ``source`` with ``root``, the n-th root of its column x, from pow and
    one Newton step whose remainder is carried in two doubles."""
    steps = [f"select *, pow(x, 1.0 / {n}) as y from {source}", "select *, 134217729.0 * y - (134217729.0 * y - y) as y1 from {}",
             "select *, y - y1 as y2, y as hi, 0.0::double as lo, {n}.0::double as slope from {}".replace("{n}", str(n))]
    for _ in range(n - 1):
        steps += ["select *, hi * y as p, 134217729.0 * hi - (134217729.0 * hi - hi) as h1 from {}", "select *, hi - h1 as h2 from {}",
                  "select *, (((h1 * y1 - p) + h1 * y2 + h2 * y1) + h2 * y2) + lo * y as e from {}",
                  "select * replace (p + e as hi, e - ((p + e) - p) as lo, slope * y as slope) from {}", "select * exclude (p, h1, h2, e) from {}"]
    steps.append("select *, y + ((x - hi) - lo) / slope as root from {}")
    names = [f"{out}_{i}" for i in range(len(steps) - 1)] + [out]
    return ",\n".join(f"{name} as ({step.format(names[i - 1] if i else source)})" for i, (name, step) in enumerate(zip(names, steps)))


T3 = VALID + f""",
t3_anchor as (select symbol,
                     arg_max(close, date) filter (where month(date) = 1) as start_price,
                     arg_max(close, date) filter (where month(date) = 6) as end_price
              from valid group by symbol),
t3_ratio as (select *, end_price / start_price as x
             from t3_anchor where start_price is not null and end_price is not null and start_price > 0),
{refined_root(5, "t3_ratio", "t3_root")},
t3_scored as (select symbol, start_price, end_price, cast(5 as integer) as n_months, root - 1.0 as monthly_cagr from t3_root),
t3 as (select symbol, start_price, end_price, n_months, monthly_cagr,
              cast(rank() over (order by monthly_cagr desc) as integer) as rank
       from t3_scored)"""

T4 = VALID + """,
t4_anchor as (select symbol, cast(date_trunc('week', date) as date) as week_monday,
                     arg_min(close, date) as start_price, arg_max(close, date) as end_price,
                     min(date) as week_start, max(date) as week_end, count(date) as n_trading_days
              from valid group by symbol, cast(date_trunc('week', date) as date)),
t4 as (select symbol, cast(year(week_monday) as integer) as year, cast(weekofyear(week_monday) as integer) as week_of_year,
              week_start, week_end, start_price, end_price,
              (end_price - start_price) / start_price as weekly_return,
              round((end_price - start_price) / start_price * 100, 4) as weekly_return_pct
       from t4_anchor where n_trading_days >= 2 and start_price > 0)"""


# T2 in DuckDB: decimal money, whole shares by integer division of micro-units.
T2 = VALID + """,
t2_anchor as (select symbol, arg_min(close, date) as start_price, arg_max(close, date) as end_price
              from valid group by symbol),
t2_base as (
  select symbol, start_price, end_price, cast(start_price as decimal(20,6)) as sp, cast(end_price as decimal(20,6)) as ep,
         cast(10000000000 // cast(cast(start_price as decimal(20,6)) * 1000000 as hugeint) as bigint) as base
  from t2_anchor where start_price > 0),
t2_rem as (select *, cast(10000 as decimal(20,6)) - base * sp as rem from t2_base),
t2_run as (select sum(rem) as pool, arg_min(symbol, row(sp, symbol)) as cheapest from t2_rem),
t2_alloc as (
  select r.*, case when r.symbol = run.cheapest
                   then cast(cast(run.pool * 1000000 as hugeint) // cast(r.sp * 1000000 as hugeint) as bigint)
                   else 0 end as extra,
         run.pool as pool, r.symbol = run.cheapest as is_cheapest
  from t2_rem r, t2_run run),
t2 as (
  select symbol, start_price, end_price, base + extra as shares_purchased,
         cast((base + extra) * sp as decimal(20,6)) as capital_invested,
         cast(greatest(rem - extra * sp, 0) as decimal(20,6)) as uninvested_cash,
         cast(round((base + extra) * ep, 4) as decimal(20,6)) as current_value,
         cast(pool - extra * sp as decimal(20,6)) as residual_if_cheapest, is_cheapest
  from t2_alloc)"""


def with_(ctes: str, select: str) -> str:
    return f"with {ctes.strip()}\n{select}"


ORACLE: dict[str, str] = {
    "bars": with_(BARS, "select symbol, date, open, high, low, close, volume, transactions from bars"),
    "relative_increase": with_(T1, "select * from t1"),
    "t1_winner": with_(T1, "select * from t1 where rank = 1"),
    "first_last_close_window": with_(VALID, """
        select symbol, arg_min(close, date) as start_price, arg_max(close, date) as end_price
        from valid group by symbol"""),
    "monthly_cagr": with_(T3, "select * from t3"),
    "t3_winner": with_(T3, "select * from t3 where rank = 1"),
    "weekly_returns": with_(T4, "select * from t4"),
    "worst_week": with_(T4, "select * from t4 order by weekly_return, symbol, week_start limit 1"),
    "week_day_counts": with_(VALID, """
        select symbol, cast(date_trunc('week', date) as date) as week_monday, min(date) as week_start,
               max(date) as week_end, count(date) as n_trading_days
        from valid group by 1, 2"""),
    "portfolio_detail": with_(T2, """
        select symbol, start_price, end_price, shares_purchased, cast(capital_invested as double) as capital_invested,
               cast(uninvested_cash as double) as uninvested_cash, cast(current_value as double) as current_value,
               cast(current_value - capital_invested as double) as pnl
        from t2"""),
    "portfolio_summary": with_(T2, """,
        t2_sum as (select coalesce(sum(capital_invested), 0) as inv, coalesce(sum(uninvested_cash), 0) as cash,
                          coalesce(sum(current_value), 0) as val, coalesce(sum(current_value - capital_invested), 0) as pnl,
                          coalesce(max(case when is_cheapest then residual_if_cheapest end), 0) as resid
                   from t2)
        select cast(round(inv, 2) as double) as total_capital_invested, cast(round(cash, 2) as double) as total_uninvested_cash,
               cast(round(val, 2) as double) as total_current_value, cast(round(pnl, 2) as double) as total_pnl,
               case when inv = 0 then 0.0
                    else round((cast(val as double) - cast(inv as double)) / cast(inv as double) * 100, 4) end as total_return_pct,
               cast(round(resid, 2) as double) as residual_cash
        from t2_sum"""),
    "bars_from_json": with_(BARS, """
        select symbol, case when volume % 71 = 0 then '1970-01-01' else strftime(date, '%Y-%m-%d') end as date,
               case when volume % 73 = 0 then 0.0::double else open end as open, high, low, close,
               case when volume % 79 = 0 then 0 else volume end as volume, case when volume % 3 = 1 then close end as vwap,
               case when volume % 83 = 0 then null else transactions end as transactions
        from bars where right(symbol, 1) not in ('C', 'D', 'E')"""),
    "fetch_failures": with_(BARS, f"""
        select s.symbol, count(distinct b.m) as n_responses, case when count(b.m) = 0 then 'never landed'
            when right(s.symbol, 1) = 'C' then 'status ERROR: Unknown API Key'
            when right(s.symbol, 1) = 'D' then 'not an envelope: <html>504 Gateway Time-out</html>' else 'no results' end as reason
        from (select {sym('s_suppkey')} as symbol from supplier) s
        left join (select symbol, date_trunc('month', date) as m from bars where right(symbol, 1) <> 'G') b using (symbol)
        where s.symbol not in (select symbol from bars where right(symbol, 1) not in ('C', 'D', 'E', 'G')) group by s.symbol"""),
    "corrupt_responses": with_(BARS, """
        select distinct on (symbol, date_trunc('month', date)) symbol, '<html>504 Gateway Time-out</html>' as body
        from bars where right(symbol, 1) = 'D'"""),
    "bars_per_symbol": with_(BARS, """
        select symbol, count(*) as n_bars from bars where right(symbol, 1) not in ('C', 'D', 'E') group by symbol"""),
    "raw_roundtrip": with_(RAW, "select * exclude (ingested_at) from raw_bars"),
    "restrict_dates": with_(VALID, """
        select * exclude (ingested_at) from valid where date between date '1997-01-01' and date '1997-12-31'"""),
    "dedupe_bars": with_(BARS, """
        select symbol, date, open, high, low, close + 0.01 as close, volume, vwap, transactions from bars"""),
    "inspect_symbol": with_(RAW, """
        select symbol, date, open, high, low, close, volume from raw_bars
        where symbol = 'AAB' and date >= '1997-01-01' and date <= '1997-12-31' order by date"""),
    "store_slice": with_(RAW, "select * exclude (ingested_at) from raw_bars where symbol in ('AAB', 'AAZ', 'ABC')"),
    "bars_as_of_reference": with_(BARS, f"""
        select b.symbol, b.date, b.close, h.as_of, h.http_status, h.type from bars b asof left join (
          select {sym('k')} as symbol, cast(m + to_days(cast((k * 7 + month(m) * 5) % 28 as integer)) as date) as as_of,
                 cast(case (k + year(m) * 12 + month(m)) % 9 when 0 then 404 when 1 then null when 2 then 403 else 200 end as integer) as http_status,
                 case when (k + month(m)) % 5 = 0 then 'ETF' else 'CS' end as type
          from (select distinct l_suppkey as k, cast(date_trunc('month', l_shipdate) as date) as m from lineitem)) h
        on b.symbol = h.symbol and b.date >= h.as_of"""),
    "company_list": f"select s_name || ' Inc.' as company_name, {sym('s_suppkey')} as symbol from supplier",
    "validate_valid": with_(VALID, "select * exclude (ingested_at) from valid"),
    "validate_quarantine": with_(FLAGGED, """
        select symbol, date, open, high, low, close, volume, vwap, transactions, date_raw, failure_reason
        from flagged where failure_reason is not null"""),
    "quarantine_reasons": with_(FLAGGED, """
        select failure_reason, count(*) as n from flagged where failure_reason is not null group by 1"""),
    "validation_metrics": with_(FLAGGED, """
        select count(*) as total_input, cast(count_if(failure_reason is null) as bigint) as total_valid,
               cast(count_if(failure_reason is not null) as bigint) as total_quarantine,
               case when count(*) = 0 then 1.0 else count_if(failure_reason is null) / count(*) end as pass_rate
        from flagged"""),
}


# ----------------------------------------------------------------- tickers
LEGAL = r"\b(inc|incorporated|corp|corporation|co|company|ltd|limited|plc|llc|group|holdings|international|class\s+[a-c]|the)\b"


def words(x: str) -> str:
    return (f"list_distinct(list_filter(string_split_regex(trim(regexp_replace(regexp_replace("
            f"lower(coalesce({x}, '')), '[^a-z0-9\\s]', ' ', 'g'), '{LEGAL}', ' ', 'gi')), '\\s+'), lambda w: length(w) >= 3))")


def names_match(e: str, a: str, s: str) -> str:
    return (f"(case when len({words(e)}) = 0 then true when len({words(a)}) = 0 then false "
            f"when list_has_any({words(e)}, {words(a)}) then true "
            f"when coalesce({s}, '') <> '' then coalesce(regexp_matches({a}, '(?i)\\b' || regexp_escape({s}) || '\\b'), false) "
            f"else false end)")


EDGES = """(values (1000000000000, 'Apple Inc.', ' aapl '), (1000000000001, 'Apple Inc.', 'AAPL'),
  (1000000000002, 'Berkshire Hathaway Inc. Class B', 'BRK.B'), (1000000000003, 'Too Long Corp', 'TOOLONG'),
  (1000000000004, 'Numbers Inc', '123'), (1000000000005, 'Blank Co', ''), (1000000000006, 'Null Co', null),
  (1000000000007, 'Bad Class Inc', 'A.BCD'),
  (1000000000008, 'Tab Inc', chr(9) || 'TABS ' || chr(10)), (1000000000009, 'Apple Computer', 'AAPL')) as v(position, company_name, symbol)"""

K = "s_suppkey"
TICKERS = f"""
companies as (
  select {K} as position, s_name || ' Inc.' as company_name, {sym(K)} as symbol from supplier
  union all select * from {EDGES}),
ref as (
  select {sym(K)} as symbol,
         cast(case when {K} % 20 = 0 then 404 when {K} % 20 = 1 then 403 when {K} % 20 = 2 then 500
                   when {K} % 20 = 3 then null when {K} % 20 = 4 then 429 when {K} % 20 = 5 then 301 else 200 end as integer) as http_status,
         case when {K} % 23 = 0 then null else {K} % 11 <> 0 end as active,
         case when {K} % 23 = 0 then null when {K} % 13 = 0 then 'ETF' when {K} % 17 = 0 then null else 'cs' end as type,
         case when {K} % 23 = 0 then null when {K} % 21 = 0 then {sym(K)} || ' Aerospace' when {K} % 7 = 0 then 'Unrelated Trading Corp'
              when {K} % 9 = 0 then 'The Group Inc' else s_name end as name
  from supplier),
lrows as (select position, company_name as listed_name,
                 coalesce(upper(regexp_replace(symbol, '^\\s+|\\s+$', '', 'g')), '') as symbol from companies),
firsts as (select symbol, min(position) as position, arg_max(listed_name, position) as last_name
           from lrows where symbol <> '' group by symbol),
vj as (
  select r.*, coalesce(f.last_name, r.listed_name) as expected_name, f.position is not null as is_first, ref.symbol is not null as has_record, ref.http_status, ref.active,
         ref.type, ref.name as actual_name
  from lrows r left join firsts f on r.symbol = f.symbol and r.position = f.position
  left join ref on r.symbol = ref.symbol)"""

_BRANCHES = [
    ("symbol = ''", "invalid", "'Empty symbol'", None),
    ("not is_first", "duplicate", None, "'Duplicate symbol: ' || symbol"),
    ("not regexp_matches(symbol, '^[A-Z]{1,5}(\\.[A-Z]{1,2})?$')", "invalid",
     "'Invalid format ''' || symbol || ''' — expected 1-5 uppercase letters'", None),
    ("not has_record or http_status is null", "valid", None, "'API unreachable: no reference record'"),
    ("http_status = 404", "invalid", "'Ticker not found on Polygon — may be delisted or renamed'", None),
    ("http_status = 403", "valid", None, "'Could not verify (API permission issue)'"),
    ("http_status >= 400", "valid", None, "'API returned ' || http_status"),
    ("active is null and type is null and actual_name is null", "invalid", "'No reference data returned by Polygon'", None),
    ("not coalesce(active, true)", "invalid", "'Ticker is inactive/delisted (was: ''' || coalesce(actual_name, '') || ''')'", None),
    ("coalesce(type, '') <> '' and upper(type) <> 'CS'", "invalid",
     "'''' || coalesce(actual_name, '') || ''' is not a stock (Polygon type: ''' || type || ''')'", None),
    (f"coalesce(expected_name, '') <> '' and coalesce(actual_name, '') <> '' "
     f"and not {names_match('expected_name', 'actual_name', 'symbol')}", "invalid",
     "'Company name mismatch — expected ''' || expected_name || ''' but Polygon returned ''' || actual_name || "
     "'''. This ticker may have been reused by a different company.'", None),
]


def _case(i: int, default: str) -> str:
    arms = " ".join(f"when {c} then {b[i] if b[i] is not None else 'null'}"
                    for c, *b in [(x[0], f"'{x[1]}'", x[2], x[3]) for x in _BRANCHES])
    return f"case {arms} else {default} end"


VETTING = TICKERS + f""",
vetting as (
  select position, symbol, outcome, reason, warning,
         case when outcome = 'valid' and warning is null then actual_name end as matched_name
  from (select *, {_case(0, "'valid'")} as outcome, {_case(1, 'null')} as reason, {_case(2, 'null')} as warning
        from vj))"""

# each listing has a date; the reference has an older and a newer record a symbol
AS_LISTED = VETTING.replace("\nlrows as (", """
dated as (
  select symbol, 500 as http_status, active, type, name, date '1990-01-01' as as_of from ref
  union all select *, date '1995-01-01' from ref
  union all select symbol, 404, active, type, name, date '2035-01-01' from ref),
lrows as (""").replace("left join ref on r.symbol = ref.symbol)", """asof left join dated ref on r.symbol = ref.symbol
    and cast(date '1988-01-01' + to_days(cast(r.position * 197 % 20000 as integer)) as date) >= ref.as_of)""")

ORACLE.update({
    "ticker_vetting": with_(VETTING, "select * from vetting"),
    "ticker_vetting_as_listed": with_(AS_LISTED, "select * from vetting"),
    "ticker_duplicates": with_(TICKERS, """
        select symbol, count(*) as n, min(position) as first_position from lrows where symbol <> ''
        group by symbol having count(*) > 1"""),
    "ticker_report": with_(VETTING, """
        select cast(count_if(outcome in ('valid', 'invalid')) as bigint) as total,
               cast(count_if(outcome = 'valid') as bigint) as valid,
               cast(count_if(outcome = 'invalid') as bigint) as invalid,
               cast(count_if(warning is not null) as bigint) as warnings
        from vetting"""),
    "ticker_findings": with_(VETTING, """
        select 'warning' as kind, position, symbol, warning as text from vetting where warning is not null
        union all select 'invalid', position, symbol, reason from vetting where outcome = 'invalid'"""),
    "name_match": with_(TICKERS, f"""
        select c.symbol, array_to_string(list_sort({words('c.company_name')}), ' ') as expected_words,
               array_to_string(list_sort({words('ref.name')}), ' ') as actual_words,
               {names_match('c.company_name', 'ref.name', 'c.symbol')} as names_match
        from companies c join ref on c.symbol = ref.symbol"""),
    "bars_for_valid_tickers": with_(BARS + "," + VETTING, """
        select symbol, date, open, high, low, close, volume, transactions from bars
        where symbol in (select symbol from vetting where outcome = 'valid')"""),
})
