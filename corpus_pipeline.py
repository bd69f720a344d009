"""The corpus pipeline: quality, near-dedup, decontamination, secrets, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the
columns of ``documents``.  Each stage's result is written as Parquet in the shared scratch
folder and read back as the next one's input, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cloudmarts.llm import decontaminate, packing, quality_fm, secrets_cnn, simhash
from cloudmarts.llm.components import stage
from cloudmarts.llm.queries import crc_of_ids

ORACLE_SQL = None  # model scores, XXH64 and token ids have no SQL form; tests/llm has brute force


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the factorisation machine scores at the threshold or above."""
    return quality_fm.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest doc_id."""
    return simhash.dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked in the text."""
    return secrets_cnn.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece in a training sequence."""
    return packing.pack(docs, derive={"ids_crc32": crc_of_ids()})


STAGES = [("quality_classifier", quality), ("simhash_dedup", near_dedup),
          ("decontamination", decontamination), ("secret_scan", secrets), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
