from __future__ import annotations

import os

from barsmith.operators import quality
from barsmith.plans import inputs
from barsmith.sources import lineitem_bars as lb
from barsmith.sources import payloads
from barsmith.streaming.landing import read_gated, start_gate_stream
from tests.conftest import SF0001


def test_gate_stream_matches_batch(spark, scratch):
    landing = os.path.join(scratch, "landing")
    bars = inputs.raw_bars(spark, SF0001).selectExpr(
        "symbol", "try_to_date(date) as date", "open", "high", "low", "close", "volume", "vwap", "transactions"
    ).where("date is not null")
    lb.payload_lines_from_bars(bars).repartition(4).write.text(landing)
    out = os.path.join(scratch, "out")
    q = start_gate_stream(spark, landing, out, os.path.join(scratch, "ckpt"))
    q.awaitTermination(300)
    assert q.exception() is None
    batch = quality.flag(payloads.bars_from_payloads(payloads.read_payload_files(spark, landing), "2026-01-05 00:00:00"))
    cols = ["symbol", "date", "close", "volume"]
    got_valid = read_gated(spark, out, "valid").select(*cols)
    want_valid = quality.valid(batch).select(*cols)
    assert got_valid.exceptAll(want_valid).count() == 0 and want_valid.exceptAll(got_valid).count() == 0
    assert read_gated(spark, out, "quarantine").count() == quality.quarantine(batch).count()
    m = spark.read.parquet(os.path.join(out, "validation_metrics")).selectExpr(
        "sum(total_input) n", "sum(total_valid) v").collect()[0]
    assert (m.n, m.v) == (batch.count(), quality.valid(batch).count())
    reasons = spark.read.parquet(os.path.join(out, "quarantine_reasons")).groupBy("failure_reason").sum("n")
    assert {r[0]: r[1] for r in reasons.collect()} == {r.failure_reason: r.n for r in quality.reason_counts(batch).collect()}
    # a second availableNow run finds nothing new and adds nothing
    before = read_gated(spark, out, "valid").count()
    q2 = start_gate_stream(spark, landing, out, os.path.join(scratch, "ckpt"))
    q2.awaitTermination(300)
    assert read_gated(spark, out, "valid").count() == before


def test_a_batch_that_did_not_commit_is_not_read(spark, scratch):
    """A batch folder without its row under ``committed`` is a write that died."""
    landing, out = os.path.join(scratch, "landing"), os.path.join(scratch, "out")
    bars = inputs.bars(spark, SF0001).where("date >= date'1997-01-01' and date < date'1997-03-01'")
    lb.payload_lines_from_bars(bars).repartition(3).write.text(landing)
    start_gate_stream(spark, landing, out, os.path.join(scratch, "ckpt"), max_files_per_trigger=1).awaitTermination(300)
    whole = read_gated(spark, out).count()
    batches = sorted(os.listdir(os.path.join(out, "committed")))
    assert whole > 0 and len([b for b in batches if b.startswith("batch=")]) == 3  # a file a batch
    import shutil
    shutil.copytree(os.path.join(out, "gated", "batch=0"), os.path.join(out, "gated", "batch=99"))
    assert read_gated(spark, out).count() == whole
    assert [f.name for f in read_gated(spark, out).schema][:1] == ["batch"]
