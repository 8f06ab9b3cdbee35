"""Incremental ingestion: new landed envelope files -> quality gate.

The same operators as the batch job (envelope flattening, rule flags) run on
a Structured Streaming file source.  Each micro-batch is written in one pass
into ``<output>/gated/batch=<id>/layer=valid|quarantine``, with its reason
counts and gate metrics under ``quarantine_reasons/batch=<id>`` and
``validation_metrics/batch=<id>``.  Batch folders are overwritten on a retry,
so a replayed batch after a failure leaves exactly one copy.  A batch's last
write is its row under ``committed/batch=<id>``; readers take the batches that
have one, so a batch that is being written is not seen.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from barsmith.operators import quality
from barsmith.schemas import RAW_BARS
from barsmith.sources.payloads import bars_from_payloads, parse_payload_lines


def landed_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming flagged bars from JSON-lines envelope files."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    envelopes = parse_payload_lines(reader.text(landing_dir))
    flagged = quality.flag(bars_from_payloads(envelopes, F.current_timestamp()))
    return flagged.withColumn(
        "layer", F.when(F.col(quality.REASON).isNull(), F.lit("valid")).otherwise(F.lit("quarantine")))


def start_gate_stream(
    spark: SparkSession,
    landing_dir: str,
    output_dir: str,
    checkpoint_dir: str,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the gate stream.  ``available_now`` processes what has landed and
    stops (a scheduled run); otherwise it runs on ``processing_time``.
    ``max_files_per_trigger`` bounds a micro-batch."""
    out = output_dir.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        gated = f"{out}/gated/batch={batch_id}"
        batch.write.mode("overwrite").partitionBy("layer").parquet(gated)
        # gate metrics of this micro-batch, from the written batch (one small scan)
        written = batch.sparkSession.read.schema(batch.schema).parquet(gated)
        quality.reason_counts(written).write.mode("overwrite").parquet(f"{out}/quarantine_reasons/batch={batch_id}")
        quality.metrics(written).write.mode("overwrite").parquet(f"{out}/validation_metrics/batch={batch_id}")
        batch.sparkSession.range(1).selectExpr("current_timestamp() as committed_at").write.mode("overwrite").parquet(f"{out}/committed/batch={batch_id}")

    writer = landed_stream(spark, landing_dir, max_files_per_trigger).writeStream.foreachBatch(write_batch) \
        .option("checkpointLocation", checkpoint_dir)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "1 minute")
    return writer.start()


def read_gated(spark: SparkSession, output_dir: str, layer: str = "valid") -> DataFrame:
    """All committed micro-batches of one layer, with a fixed schema.  The join
    on the batch prunes the folders of batches that did not commit."""
    out = output_dir.rstrip("/")
    flagged = quality.flag(spark.createDataFrame([], RAW_BARS)).schema
    rows = spark.read.schema(StructType([*flagged.fields, StructField("batch", LongType()), StructField("layer", StringType())])).parquet(f"{out}/gated")
    done = spark.read.schema("committed_at timestamp, batch long").parquet(f"{out}/committed").select("batch").distinct()
    return rows.where(F.col("layer") == layer).join(done, "batch", "left_semi")
