"""The batch job: company list -> (vetting) -> landed bars -> RAW store ->
quality gate -> VALID store -> T1..T4 results.

Persisted layers are written tables under ``output_dir`` (a shared folder on a
cluster): RAW, then the gated bars (``gated/layer=valid`` and
``gated/layer=quarantine``, written in one pass) are written once and read
back.  That cuts the lineage -- a lost executor recomputes from the last
written table, not from the landing files -- and the analytics never re-run
the gate.  The valid partition is read once (four columns) into the
de-duplicated ``valid_closes`` table, which is scanned once for the per-symbol
anchors behind T1-T3 (also written) and once for T4's weeks.  The only values
brought to the driver are one-row summaries for the report.

All tables of a run lie in a folder of its own and are published as one when
the last is written (:mod:`barsmith.plans.publish`).
"""
from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.functions.symbols import normalise_symbol
from barsmith.operators import bars as bars_ops
from barsmith.operators import quality, tickers
from barsmith.plans import analytics, portfolio
from barsmith.plans.publish import Folder, Run, published
from barsmith.schemas import RAW_BARS, TICKER_REFERENCE, TICKER_VETTING
from barsmith.sources import bar_store, company_list, payloads

# Default analysis period and budget per company.
DEFAULT_START = "2025-01-01"
DEFAULT_END = "2025-12-31"
DEFAULT_INVESTMENT_PER_STOCK = 10_000.0


class JobError(RuntimeError):
    """The job cannot continue (missing input, nothing valid to fetch)."""


@dataclass(frozen=True)
class JobConfig:
    output_dir: str
    companies_path: str | None = None
    payloads_path: str | None = None
    reference_path: str | None = None
    start_date: str | None = DEFAULT_START
    end_date: str | None = DEFAULT_END
    validate_tickers: bool = False
    skip_ingestion: bool = False
    investment_per_stock: float = DEFAULT_INVESTMENT_PER_STOCK
    ingested_at: str | None = None
    # one bar per (symbol, date) before the analytics (re-deliveries: latest wins)
    dedupe: bool = True


def stored_raw(spark: SparkSession, root: str) -> str | None:
    """The folder of the RAW bars: those of the published run, else a store that
    was put at ``raw`` by hand."""
    if path := published(spark, root).get("raw"):
        return path
    return f"{root.rstrip('/')}/raw" if Folder(spark, root).exists("raw") else None


def _stored(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write a result and read it back with its own schema, rows or none."""
    bar_store.write_result(df, path)
    return spark.read.schema(df.schema).parquet(path)


def ingest(spark: SparkSession, cfg: JobConfig, run_: Run) -> DataFrame:
    """Landed envelopes for the requested (optionally vetted) symbols -> RAW
    store; returns the store read back."""
    if not cfg.companies_path or not cfg.payloads_path:
        raise JobError("ingestion needs companies_path and payloads_path")
    companies = company_list.read_company_list(spark, cfg.companies_path, with_position=True)
    if cfg.validate_tickers:
        if not cfg.reference_path:
            raise JobError("--validate-tickers needs reference_path")
        reference = spark.read.schema(TICKER_REFERENCE).parquet(cfg.reference_path)
        vetting = _stored(spark, tickers.vet_tickers(companies, reference, as_of=cfg.start_date).select(*TICKER_VETTING.names),
                          run_.path("ticker_vetting"))
        bar_store.write_result(tickers.report(vetting), run_.path("ticker_report"))
        bar_store.write_result(tickers.findings(vetting), run_.path("ticker_findings"))
        requested = tickers.valid_symbols(vetting)
        if requested.isEmpty():
            raise JobError("No valid tickers to fetch. Aborting.")
    else:
        requested = (companies.select(normalise_symbol(F.col("symbol")).alias("symbol"))
                     .where(F.col("symbol") != "").distinct())
    stamp = cfg.ingested_at or dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    responses = payloads.read_payload_files(spark, cfg.payloads_path)
    landed = payloads.bars_from_payloads(responses, stamp)
    # the requested range applies at the source, as a date-ranged fetch would
    landed = bars_ops.restrict_dates(landed, cfg.start_date, cfg.end_date)
    raw = bars_ops.for_symbols(landed, requested)
    bar_store.write_bars(raw, run_.path("raw"))
    raw = bar_store.read_bars(spark, run_.path("raw"), RAW_BARS)
    bar_store.write_result(payloads.fetch_failures(requested, responses), run_.path("fetch_failures"))
    bar_store.write_result(payloads.corrupt_responses(responses), run_.path("corrupt_responses"))
    bar_store.write_result(payloads.bars_per_symbol(raw), run_.path("bars_per_symbol"))
    return raw


def run(spark: SparkSession, cfg: JobConfig) -> dict:
    """Run the whole job and publish its tables; returns the one-row summaries as
    plain values."""
    run_ = Run(spark, cfg.output_dir)
    if cfg.skip_ingestion:
        path = stored_raw(spark, cfg.output_dir)
        if path is None:
            raise JobError(f"--skip-ingestion was set but no raw data found below '{cfg.output_dir}'")
        run_.tables["raw"] = path  # stays where an earlier run wrote it
        raw = bar_store.read_bars(spark, path, RAW_BARS)
    else:
        raw = ingest(spark, cfg, run_)

    # one pass over RAW: every row lands in layer=valid or layer=quarantine, in
    # its month's folder, so that the analysis period prunes
    flagged = (quality.flag(raw, quality.rules(finite_prices=True))
               .withColumn("layer", F.when(F.col(quality.REASON).isNull(), F.lit("valid")).otherwise(F.lit("quarantine")))
               .withColumn(bar_store.MONTH, bar_store.month_of()))
    (flagged.hint("rebalance", "layer", bar_store.MONTH)
        .write.mode("overwrite").partitionBy("layer", bar_store.MONTH).parquet(run_.path("gated")))
    gated = spark.read.schema(flagged.schema).parquet(run_.path("gated"))
    # reasons and metrics from one aggregate over the gated table
    outcomes = _stored(spark, quality.outcome_counts(gated), run_.path("gate_outcomes"))
    bar_store.write_result(outcomes.where(F.col(quality.REASON).isNotNull()), run_.path("quarantine_reasons"))
    bar_store.write_result(quality.metrics_from_counts(outcomes), run_.path("validation_metrics"))
    valid = valid_in_period(gated, cfg)

    if cfg.dedupe:
        # a re-delivered bar must not count twice (T4's day count) nor make the
        # first/last close arbitrary.  Only the columns the analytics read are
        # shuffled, and the result is written once for both consumers below.
        narrow = bars_ops.dedupe_bars(valid.select("symbol", "date", "close", "ingested_at"))
        valid = _stored(spark, narrow, run_.path("valid_closes"))

    # one scan of VALID answers T1-T3: the per-symbol anchors are written once
    anchors = _stored(spark, analytics.symbol_anchors(valid), run_.path("symbol_anchors"))
    allocation = portfolio.allocation_from_anchors(anchors, cfg.investment_per_stock)
    results = {
        "t1_relative_increase": analytics.relative_increase_from_anchors(anchors),
        "t2_left_out": portfolio.left_out(anchors),
        "t2_portfolio_detail": portfolio.detail_from_allocation(allocation),
        "t2_portfolio_summary": portfolio.summary_from_allocation(allocation),
        "t3_monthly_cagr": analytics.monthly_cagr_from_anchors(anchors),
        "t4_weekly_decrease": analytics.worst_weeks(valid, k=1),
    }
    for name, df in results.items():
        # a ranked result's files come in rank order
        (bar_store.write_ranked if "rank" in df.columns else bar_store.write_result)(df, run_.path(name))
    run_.publish()

    def stored(name: str) -> DataFrame:
        return spark.read.schema(results[name].schema).parquet(run_.path(name))

    def one(df: DataFrame) -> dict | None:
        """The first row; of tied winners that of the first symbol."""
        rows = (df.orderBy("symbol") if "symbol" in df.columns else df).limit(1).collect()
        return rows[0].asDict() if rows else None

    def first(name: str) -> tuple[dict | None, int]:
        """The winner and how many share the first rank."""
        best = stored(name).where("rank = 1")
        return one(best), best.count()

    t1, t1_tied = first("t1_relative_increase")
    t3, t3_tied = first("t3_monthly_cagr")
    return {
        "validation": one(quality.metrics_from_counts(outcomes)),
        "t1_winner": t1,
        "t1_winners": t1_tied,
        "t2_summary": one(stored("t2_portfolio_summary")),
        "t3_winner": t3,
        "t3_winners": t3_tied,
        "t4_worst_week": one(stored("t4_weekly_decrease")),
    }


def valid_in_period(gated: DataFrame, cfg: JobConfig) -> DataFrame:
    """VALID bars of the analysis period, which applies whether bars were
    fetched or re-read; the month bounds only read the period's folders."""
    month = F.col(bar_store.MONTH)
    rows = gated.where(F.col("layer") == "valid")
    if cfg.start_date is not None:
        rows = rows.where(month >= cfg.start_date[:7])
    if cfg.end_date is not None:
        rows = rows.where(month <= cfg.end_date[:7])
    return bars_ops.restrict_dates(quality.valid(rows), cfg.start_date, cfg.end_date)
