"""A corpus from raw documents to token ids, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on every row of ``docs``.  All
but the last return rows with the columns of ``docs``; the rows of a stage are
written and read again as the next stage's ``docs``.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.llm.bpe_codec import encode
from barsmith.llm.common import written
from barsmith.llm.decontaminate import clean
from barsmith.llm.near_dedup import one_of_each
from barsmith.llm.pii import redact
from barsmith.llm.quality_rules import keep_good


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are good by the rules' votes."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each class of near duplicates."""
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with personal data masked; ``n_chars`` follows the text."""
    masked = redact(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.when(F.col("text").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and the token ids of its text, with their number."""
    return encode(docs, ["doc_id"]).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pii", pii),
    ("bpe", bpe),
]

#: SQL can't express the fitted models and searches of the stages
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
