"""Registered queries: key -> (spark, data_dir) -> DataFrame.

Each runs a library operator over inputs that Spark derives from the whole
driver tables (:mod:`barsmith.plans.inputs`).  Column names match the oracle
SQL in ``oracle/sql.py``.
"""
from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.functions import names
from barsmith.operators import bars as bars_ops
from barsmith.operators import quality, tickers
from barsmith.operators.anchors import first_last_window
from barsmith.operators.asof import as_of
from barsmith.plans import analytics, inputs, portfolio
from barsmith.session import ensure_checkpoint_dir
from barsmith.sources import bar_store, company_list, payloads
from barsmith.sources import lineitem_bars as lb

Query = Callable[[SparkSession, str], DataFrame]


def q_bars(spark, d):
    return inputs.bars(spark, d).select(*lb.BAR_COLUMNS)


def q_relative_increase(spark, d):
    return analytics.relative_increase(inputs.valid_bars(spark, d))


def q_t1_winner(spark, d):
    return analytics.increase_winners(inputs.valid_bars(spark, d))


def q_first_last_close_window(spark, d):
    return first_last_window(inputs.valid_bars(spark, d).select("symbol", "date", "close"))


def q_monthly_cagr(spark, d):
    return analytics.monthly_cagr(inputs.valid_bars(spark, d))


def q_t3_winner(spark, d):
    return analytics.growth_winners(inputs.valid_bars(spark, d))


def q_weekly_returns(spark, d):
    return analytics.weekly_returns(inputs.valid_bars(spark, d))


def q_worst_week(spark, d):
    return analytics.worst_weeks(inputs.valid_bars(spark, d), k=1)


def q_week_day_counts(spark, d):
    return analytics.week_days(inputs.valid_bars(spark, d))


def q_portfolio_detail(spark, d):
    return portfolio.portfolio_detail(inputs.valid_bars(spark, d))


def q_portfolio_summary(spark, d):
    return portfolio.portfolio_summary(inputs.valid_bars(spark, d))


def _flagged(spark, d):
    return quality.flag(inputs.raw_bars(spark, d))


def q_validate_valid(spark, d):
    return quality.valid(_flagged(spark, d)).drop("ingested_at")


def q_validate_quarantine(spark, d):
    return quality.quarantine(_flagged(spark, d)).drop("ingested_at")


def q_quarantine_reasons(spark, d):
    return quality.reason_counts(_flagged(spark, d))


def q_validation_metrics(spark, d):
    return quality.metrics(_flagged(spark, d))


def q_bars_from_json(spark, d):
    return inputs.landed_bars(spark, d, never_landed=None).drop("ingested_at")


def q_fetch_failures(spark, d):
    return payloads.fetch_failures(inputs.company_list(spark, d), inputs.responses(spark, d))


def q_corrupt_responses(spark, d):
    return payloads.corrupt_responses(inputs.responses(spark, d))


def q_bars_per_symbol(spark, d):
    return payloads.bars_per_symbol(inputs.landed_bars(spark, d, never_landed=None))


def _scratch(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _kept(df, path):
    """``df``, read from a scratch folder that goes away: its rows move to a
    checkpoint, which Spark's cleaner owns."""
    rows = df.checkpoint()
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(conf).delete(folder, True)
    return rows


def q_raw_roundtrip(spark, d):
    """RAW bars -> month-partitioned parquet -> read back with the schema."""
    path = _scratch(spark, "raw")
    bar_store.write_bars(inputs.raw_bars(spark, d), path)
    return _kept(bar_store.read_bars(spark, path).drop("ingested_at"), path)


def q_restrict_dates(spark, d):
    return bars_ops.restrict_dates(inputs.valid_bars(spark, d), "1997-01-01", "1997-12-31").drop("ingested_at")


def q_dedupe_bars(spark, d):
    """Bars delivered three times: the first copy, and two re-deliveries one day
    later with other closes.  Dedupe keeps that of the two with the higher one."""
    first = inputs.bars(spark, d)
    again = first.withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 DAY")) \
                 .withColumn("close", F.col("close") + F.lit(0.01))
    tied = again.withColumn("close", F.col("close") - F.lit(0.02))
    return bars_ops.dedupe_bars(first.unionByName(again).unionByName(tied)).drop("ingested_at")


def q_inspect_symbol(spark, d):
    # the condition on the symbol's key is pushed down to the scan of the trades
    return bars_ops.inspect_symbol(inputs.raw_bars(spark, d, "AAB"), "AAB", "1997-01-01", "1997-12-31")


def q_store_slice(spark, d):
    """Three symbols' bars out of a store clustered by symbol."""
    path = _scratch(spark, "slices")
    bar_store.write_clustered(inputs.raw_bars(spark, d), path)
    return _kept(bar_store.read_slice(spark, path, ["AAB", "AAZ", "ABC"]).drop("ingested_at"), path)


def q_bars_as_of_reference(spark, d):
    """Every bar with the reference record known on its day."""
    return as_of(inputs.bars(spark, d).select("symbol", "date", "close"), inputs.reference_history(spark, d), "symbol", "date", "as_of")


def q_company_list(spark, d):
    path = _scratch(spark, "companies")
    company_list.write_company_list(inputs.company_list(spark, d), path)
    return _kept(company_list.read_company_list(spark, path), path)


def q_ticker_vetting(spark, d):
    return tickers.vet_tickers(inputs.listings(spark, d), inputs.ticker_reference(spark, d), as_of="1997-01-01")


def q_ticker_vetting_as_listed(spark, d):
    """Each listing vetted by what was known on its own date."""
    dated = inputs.listings(spark, d).withColumn("listed_on", F.expr("date_add(date'1988-01-01', cast(position * 197 % 20000 as int))"))
    return tickers.vet_tickers(dated, inputs.ticker_reference(spark, d), listed_on="listed_on")


def q_ticker_duplicates(spark, d):
    return tickers.duplicates(inputs.listings(spark, d))


def q_ticker_report(spark, d):
    return tickers.report(q_ticker_vetting(spark, d))


def q_ticker_findings(spark, d):
    return tickers.findings(q_ticker_vetting(spark, d))


def q_name_match(spark, d):
    """Expected (listing) vs actual (reference) name for every supplier."""
    companies = inputs.company_list(spark, d)
    ref = tickers.reference_as_of(inputs.ticker_reference(spark, d), "1997-01-01").select(
        "symbol", F.col("name").alias("actual_name"))
    pairs = companies.join(ref, "symbol", "inner")
    words = lambda c: F.array_join(F.array_sort(names.name_words(F.col(c))), " ")
    return pairs.select(
        "symbol",
        words("company_name").alias("expected_words"),
        words("actual_name").alias("actual_words"),
        names.names_match(F.col("company_name"), F.col("actual_name"), F.col("symbol")).alias("names_match"),
    )


def q_bars_for_valid_tickers(spark, d):
    valid = tickers.valid_symbols(q_ticker_vetting(spark, d))
    # the trades are cut down before they are aggregated, by key
    keys = inputs.symbol_keys(spark, d, valid)
    return lb.bars_from_trades(inputs.trades(spark, d).join(keys, "key", "left_semi")).select(*lb.BAR_COLUMNS)


QUERIES: dict[str, Query] = {
    "bars": q_bars,
    "relative_increase": q_relative_increase,
    "t1_winner": q_t1_winner,
    "first_last_close_window": q_first_last_close_window,
    "monthly_cagr": q_monthly_cagr,
    "t3_winner": q_t3_winner,
    "weekly_returns": q_weekly_returns,
    "worst_week": q_worst_week,
    "week_day_counts": q_week_day_counts,
    "portfolio_detail": q_portfolio_detail,
    "portfolio_summary": q_portfolio_summary,
    "bars_from_json": q_bars_from_json,
    "fetch_failures": q_fetch_failures,
    "corrupt_responses": q_corrupt_responses,
    "bars_per_symbol": q_bars_per_symbol,
    "raw_roundtrip": q_raw_roundtrip,
    "restrict_dates": q_restrict_dates,
    "dedupe_bars": q_dedupe_bars,
    "inspect_symbol": q_inspect_symbol,
    "store_slice": q_store_slice,
    "bars_as_of_reference": q_bars_as_of_reference,
    "company_list": q_company_list,
    "ticker_vetting": q_ticker_vetting,
    "ticker_vetting_as_listed": q_ticker_vetting_as_listed,
    "ticker_duplicates": q_ticker_duplicates,
    "ticker_report": q_ticker_report,
    "ticker_findings": q_ticker_findings,
    "name_match": q_name_match,
    "bars_for_valid_tickers": q_bars_for_valid_tickers,
    "validate_valid": q_validate_valid,
    "validate_quarantine": q_validate_quarantine,
    "quarantine_reasons": q_quarantine_reasons,
    "validation_metrics": q_validation_metrics,
}
