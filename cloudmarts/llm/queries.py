"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloudmarts.llm import (
    decontaminate,
    importance,
    packing,
    pii_crf,
    preferences,
    quality_fm,
    runs,
    secrets_cnn,
    shards,
    simhash,
    syncmers,
    token_files,
    url_rules,
)


def crc_of_ids():
    return F.crc32("ids")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.scan_pii(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_crf")


def op3_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = syncmers.edited_fingerprints(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"),
        syncmers.sketch_hex("sketch").alias("fingerprint"),
        syncmers.sketch_hex("edited_sketch").alias("edited_fingerprint"),
        syncmers.likeness("sketch", "edited_sketch").alias("near_edited"),
        syncmers.likeness("sketch", "next_sketch").alias("near_next"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, sf_dir, "documents")).select(
        "doc_id", simhash.fingerprint_hex().alias("fingerprint"), "component_id")


def op5_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.balanced_shards(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets_cnn.scan_secrets(_table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.format_preferences(*preferences.swapped_answers(_table(spark, sf_dir, "conversations")))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(_table(spark, sf_dir, "pages")).drop("pattern")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), derive={"ids_crc32": crc_of_ids()})


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = token_files.write_token_files(_table(spark, sf_dir, "documents"))
    return token_files.read_token_files(spark, written).drop("position")


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("n_words")


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(runs.with_planted_runs(_table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_fm, op2_pii_crf, op3_syncmers, op4_simhash, op5_byte_shards, op6_secrets,
        op7_decontaminate, op8_preferences, op9_url_rules, op10_packing, op11_token_files,
        op12_importance, op13_runs)}
ORACLE: dict[str, str] = {"op8_preferences": preferences.oracle_sql(), "op9_url_rules": url_rules.oracle_sql()}
