from __future__ import annotations

import os

import pytest

from barsmith.plans import analytics, inputs
from barsmith.plans.job import JobConfig, JobError, run
from barsmith.plans.publish import Folder, Run, published
from barsmith.sources import lineitem_bars as lb
from barsmith.sources.company_list import write_company_list
from tests.conftest import SF0001


@pytest.fixture()
def landed(spark, scratch):
    """Company CSV, landed envelopes and a reference table from sf0.001."""
    companies = os.path.join(scratch, "companies")
    write_company_list(inputs.company_list(spark, SF0001), companies)
    landing = os.path.join(scratch, "landing")
    raw = inputs.raw_bars(spark, SF0001)
    # land the corrupted bars so the gate has work to do
    as_bars = raw.selectExpr("symbol", "try_to_date(date) as date", "open", "high", "low", "close", "volume", "vwap",
                             "transactions").where("date is not null")
    lb.payload_lines_from_bars(as_bars).write.text(landing)
    reference = os.path.join(scratch, "reference")
    inputs.ticker_reference(spark, SF0001).write.parquet(reference)
    return companies, landing, reference


def at(spark, out, name):
    """The folder of a table of the published run."""
    return published(spark, out)[name]


def test_job_end_to_end(spark, scratch, landed):
    companies, landing, reference = landed
    out = os.path.join(scratch, "out")
    cfg = JobConfig(output_dir=out, companies_path=companies, payloads_path=landing, start_date="1995-01-01",
                    end_date="2001-12-31", ingested_at="2026-01-05 00:00:00")
    summary = run(spark, cfg)
    for name in ("raw", "gated", "quarantine_reasons", "validation_metrics", "t1_relative_increase",
                 "t2_portfolio_detail", "t2_portfolio_summary", "t3_monthly_cagr", "t4_weekly_decrease",
                 "fetch_failures"):
        assert os.path.isdir(at(spark, out, name)), name
    m = summary["validation"]
    assert m["total_valid"] + m["total_quarantine"] == m["total_input"] > 0
    valid = spark.read.parquet(at(spark, out, "gated")).where("layer = 'valid'").drop("layer", "month", "failure_reason",
                                                                                          "date_raw")
    assert summary["t1_winner"]["symbol"] == analytics.increase_winners(valid).orderBy("symbol").collect()[0].symbol
    assert summary["t4_worst_week"] is not None and summary["t2_summary"]["total_capital_invested"] > 0
    # rerun from the stored RAW layer gives the same answers
    again = run(spark, JobConfig(output_dir=out, skip_ingestion=True, start_date="1995-01-01", end_date="2001-12-31"))
    assert again["t1_winner"] == summary["t1_winner"] and again["validation"] == summary["validation"]


def test_job_with_vetting_restricts_symbols(spark, scratch, landed):
    companies, landing, reference = landed
    out = os.path.join(scratch, "vetted")
    run(spark, JobConfig(output_dir=out, companies_path=companies, payloads_path=landing, reference_path=reference,
                         validate_tickers=True, start_date="1995-01-01", end_date="2001-12-31",
                         ingested_at="2026-01-05 00:00:00"))
    valid_syms = {r.symbol for r in spark.read.parquet(at(spark, out, "ticker_vetting"))
                  .where("outcome = 'valid'").collect()}
    report = spark.read.parquet(at(spark, out, "ticker_report")).collect()[0]
    assert report.valid == len(valid_syms) and report.total == report.valid + report.invalid
    per_symbol = {r.symbol: r.n_bars for r in spark.read.parquet(at(spark, out, "bars_per_symbol")).collect()}
    assert sum(per_symbol.values()) == spark.read.parquet(at(spark, out, "raw")).count() > 0
    raw_syms = {r.symbol for r in spark.read.parquet(at(spark, out, "raw")).select("symbol").distinct().collect()}
    assert raw_syms <= valid_syms


def test_skip_ingestion_without_raw_fails(spark, scratch):
    with pytest.raises(JobError):
        run(spark, JobConfig(output_dir=os.path.join(scratch, "nothing"), skip_ingestion=True))


def test_date_range_applies_on_skip_ingestion(spark, scratch, landed):
    companies, landing, _ = landed
    out = os.path.join(scratch, "ranged")
    run(spark, JobConfig(output_dir=out, companies_path=companies, payloads_path=landing, start_date="1995-01-01",
                         end_date="2001-12-31", ingested_at="2026-01-05 00:00:00"))
    run(spark, JobConfig(output_dir=out, skip_ingestion=True, start_date="1997-01-01", end_date="1997-12-31"))
    t4 = spark.read.parquet(at(spark, out, "t4_weekly_decrease")).collect()[0]
    assert str(t4.week_start).startswith("1997")


def test_source_range_limits_raw(spark, scratch, landed):
    companies, landing, _ = landed
    out = os.path.join(scratch, "src-range")
    run(spark, JobConfig(output_dir=out, companies_path=companies, payloads_path=landing, start_date="1998-01-01",
                         end_date="1998-03-31", ingested_at="2026-01-05 00:00:00"))
    dates = spark.read.parquet(at(spark, out, "raw")).selectExpr("min(date) lo", "max(date) hi").collect()[0]
    assert dates.lo >= "1998-01-01" and dates.hi <= "1998-03-31"


def test_no_valid_ticker_aborts(spark, scratch, landed):
    companies, landing, _ = landed
    ref = os.path.join(scratch, "all-404")
    inputs.ticker_reference(spark, SF0001).selectExpr(
        "symbol", "404 as http_status", "active", "type", "name", "as_of").write.parquet(ref)
    with pytest.raises(JobError, match="No valid tickers"):
        run(spark, JobConfig(output_dir=os.path.join(scratch, "abort"), companies_path=companies,
                             payloads_path=landing, reference_path=ref, validate_tickers=True,
                             start_date="1995-01-01", end_date="2001-12-31"))


def test_redelivered_bars_do_not_change_answers(spark, scratch, landed):
    companies, landing, _ = landed
    twice = os.path.join(scratch, "landing-twice")
    lines = spark.read.text(landing)
    lines.unionByName(lines).write.text(twice)
    outs = {}
    for name, path in (("once", landing), ("twice", twice)):
        out = os.path.join(scratch, f"dedupe-{name}")
        run(spark, JobConfig(output_dir=out, companies_path=companies, payloads_path=path,
                             start_date="1995-01-01", end_date="2001-12-31", ingested_at="2026-01-05 00:00:00"))
        outs[name] = out
    for result in ("t1_relative_increase", "t2_portfolio_detail", "t2_portfolio_summary", "t3_monthly_cagr",
                   "t4_weekly_decrease"):
        a = spark.read.parquet(at(spark, outs["once"], result))
        b = spark.read.parquet(at(spark, outs["twice"], result))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, result
    # the gate itself stays lossless: every delivered row is accounted for
    m = spark.read.parquet(at(spark, outs["twice"], "validation_metrics")).collect()[0]
    m1 = spark.read.parquet(at(spark, outs["once"], "validation_metrics")).collect()[0]
    assert m.total_input == 2 * m1.total_input


def test_run_in_which_nothing_arrives(spark, scratch):
    companies, landing = os.path.join(scratch, "companies"), os.path.join(scratch, "landing")
    spark.createDataFrame([("Apple Inc.", "AAPL")], "company_name string, symbol string").createOrReplaceTempView("one_company")
    write_company_list(spark.table("one_company"), companies)
    spark.createDataFrame([('{"status": "ERROR", "error": "Unknown API Key"}',)], "value string").write.text(landing)
    out = os.path.join(scratch, "out")
    got = run(spark, JobConfig(output_dir=out, companies_path=companies, payloads_path=landing, ingested_at="2026-01-05 00:00:00"))
    assert got["validation"] == {"total_input": 0, "total_valid": 0, "total_quarantine": 0, "pass_rate": 1.0}
    assert got["t1_winner"] is None and got["t3_winner"] is None and got["t4_worst_week"] is None
    assert set(got["t2_summary"].values()) == {0.0}
    for name in ("t1_relative_increase", "t3_monthly_cagr", "t4_weekly_decrease", "bars_per_symbol"):
        assert os.path.isdir(at(spark, out, name)), name
    assert [r.symbol for r in spark.read.parquet(at(spark, out, "fetch_failures")).collect()] == ["AAPL"]


def test_a_run_that_dies_leaves_the_last_one_whole(spark, scratch, landed, monkeypatch):
    """Killed after T1 of the second run: readers still see every table of the first."""
    from barsmith.plans import job
    companies, landing, _ = landed
    out = os.path.join(scratch, "out")
    cfg = dict(output_dir=out, companies_path=companies, payloads_path=landing, ingested_at="2026-01-05 00:00:00")
    run(spark, JobConfig(**cfg, start_date="1995-01-01", end_date="2001-12-31"))
    before = published(spark, out)
    t1 = sorted(map(tuple, spark.read.parquet(before["t1_relative_increase"]).collect()))

    class Killed(BaseException):
        pass

    def dies(df, path):
        if path.endswith("t2_portfolio_summary"):
            raise Killed
        df.write.parquet(path)

    with monkeypatch.context() as m, pytest.raises(Killed):
        m.setattr(job.bar_store, "write_result", dies)
        run(spark, JobConfig(**cfg, start_date="1997-01-01", end_date="1997-12-31"))
    assert published(spark, out) == before
    died = [r for r in os.listdir(os.path.join(out, "runs")) if r not in before["raw"]]
    assert len(died) == 1 and os.path.isdir(os.path.join(out, "runs", died[0], "t1_relative_increase"))
    assert sorted(map(tuple, spark.read.parquet(published(spark, out)["t1_relative_increase"]).collect())) == t1
    assert len({p.split("/runs/")[1].split("/")[0] for p in before.values()}) == 1  # one run's tables, all of them
    assert {"t1_relative_increase", "t2_left_out", "t2_portfolio_detail", "t2_portfolio_summary", "t3_monthly_cagr", "t4_weekly_decrease"} <= set(before)
    # the next run from the same RAW bars takes their folder along
    run(spark, JobConfig(output_dir=out, skip_ingestion=True, start_date="1997-01-01", end_date="1997-12-31"))
    after = published(spark, out)
    assert after["raw"] == before["raw"] and after["t1_relative_increase"] != before["t1_relative_increase"]


def test_old_publications_go_and_their_folders_too(spark, scratch):
    for i in range(4):
        r = Run(spark, scratch, f"run{i}")
        path = r.path("t")
        spark.range(i).write.parquet(path)
        if i:
            r.tables["shared"] = os.path.join(scratch, "runs/run0/t")  # named by all, so it stays
        r.publish(keep=2)
        assert published(spark, scratch)["t"] == path and spark.read.parquet(path).count() == i
    assert sorted(os.listdir(os.path.join(scratch, "runs"))) == ["run0", "run1", "run2", "run3"]
    assert [os.path.isdir(os.path.join(scratch, f"runs/run{i}/t")) for i in range(4)] == [True, False, True, True]
    # a file that is still being written is no publication
    with open(os.path.join(scratch, "published/_000000009-x.json-tmp"), "w") as f:
        f.write("{")
    assert published(spark, scratch)["t"].endswith("run3/t")
    assert Folder(spark, scratch).exists("published") and published(spark, os.path.join(scratch, "none")) == {}


def test_ranked_results_keep_their_order_in_the_files(spark, scratch):
    """File names carry the rank order, files are sorted, and the first ranks are in the first files."""
    import pyarrow.parquet as pq

    from barsmith.sources.bar_store import read_ranked, write_ranked
    df = spark.range(5000).selectExpr("concat('S', id) as symbol", "cast(case when id % 3 = 0 then 1 else id end as int) as rank").repartition(7)
    path = os.path.join(scratch, "ranked")
    write_ranked(df, path, files=6)
    files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    held = [[(r["rank"], r["symbol"]) for r in pq.read_table(os.path.join(path, f)).to_pylist()] for f in files]
    assert len(files) == 6 and all(h == sorted(h) for h in held)
    assert [x for h in held for x in h] == sorted((r["rank"], r["symbol"]) for r in df.collect())
    assert max(map(len, held)) < 3 * 5000 / 6  # the tied third is cut by symbol
    assert [r["rank"] for r in read_ranked(spark, path, df.schema).collect()] == sorted(x for h in held for x, _ in h)
    top = read_ranked(spark, path, df.schema, first=1)
    assert top.count() == 1668 and "LessThanOrEqual(rank,1)" in top._jdf.queryExecution().executedPlan().toString()


def test_job_stores_ranked_results_in_order(spark, scratch, landed):
    import pyarrow.parquet as pq
    companies, landing, _ = landed
    out = os.path.join(scratch, "out")
    run(spark, JobConfig(output_dir=out, companies_path=companies, payloads_path=landing, start_date="1995-01-01", end_date="2001-12-31"))
    for name in ("t1_relative_increase", "t3_monthly_cagr"):
        path = at(spark, out, name)
        ranks = [r for f in sorted(os.listdir(path)) if f.endswith(".parquet") for r in pq.read_table(os.path.join(path, f))["rank"].to_pylist()]
        assert ranks == sorted(ranks) and ranks[0] == 1
    failed = {r.symbol: r.reason for r in spark.read.parquet(at(spark, out, "fetch_failures")).collect()}
    assert failed["AAC"] == "status ERROR: Unknown API Key" and failed["AAG"] == "never landed" and failed["AAE"] == "no results"
    assert {r.symbol for r in spark.read.parquet(at(spark, out, "corrupt_responses")).collect()} == {"AAD"}


def test_nan_prices_are_quarantined_and_the_period_prunes(spark, scratch):
    from barsmith.plans.job import valid_in_period
    from barsmith.sources.bar_store import write_bars
    from tests.conftest import make_raw

    out = os.path.join(scratch, "out")
    raw = make_raw(spark, [{"symbol": "A", "date": "2025-01-02"}, {"symbol": "A", "date": "2025-03-03", "close": float("nan")},
                           {"symbol": "B", "date": "2025-02-03"}, {"symbol": "B", "date": "2024-12-30"}])
    write_bars(raw, os.path.join(out, "raw"))
    cfg = JobConfig(output_dir=out, skip_ingestion=True)
    got = run(spark, cfg)
    assert got["validation"]["total_quarantine"] == 1 and got["t2_summary"]["total_return_pct"] == 0.0
    reasons = spark.read.parquet(at(spark, out, "quarantine_reasons")).collect()
    assert len(reasons) == 1
    plan = valid_in_period(spark.read.parquet(at(spark, out, "gated")), cfg)._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "month" in filters and "2025-01" in filters and "layer" in filters
