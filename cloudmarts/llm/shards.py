"""Balanced contiguous shards from global byte prefix sums.

Rows are put in doc_id order over range partitions, each partition's byte and row totals are
summed over the (few) partitions, and a running sum inside each partition then gives every
row its global byte offset.  Offsets are cut at equal targets.  DataFrame functions only; no
task sees more than one range partition, whose size follows the partition count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cloudmarts.llm.components import stage

N_SHARDS = 16


def range_parts(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` with ``part`` (range partitions in the order of ``keys``) and ``tie`` (tells
    equal rows apart, so that even one key with a third of all rows is cut).  Written to the
    shared scratch folder: later steps all see the same parts."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    told = rows.withColumn("tie", F.xxhash64(F.monotonically_increasing_id()))
    return stage(told.repartitionByRange(n, *keys, "tie").withColumn("part", F.spark_partition_id()),
                 "range-parts")


def balanced_shards(docs: DataFrame, n_shards: int = N_SHARDS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, size (UTF-8 bytes + 1), text_crc32, shard, slot.

    Shards are contiguous in (doc_id, text_crc32, size) order, nulls first; a row goes where
    the middle of its bytes lies, so a shard differs from the target by less than its two
    border rows.  Null texts have size 1 and the checksum of an empty text; repeated rows get
    a slot each; equal texts need not share a shard; an empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = stage(docs.select(F.col(id_col).alias("doc_id"),
                             (F.octet_length(text) + 1).cast("long").alias("size"),
                             F.crc32(text).alias("text_crc32")), "sizes")
    order = ["doc_id", "text_crc32", "size"]
    ranged = range_parts(rows, *order)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = (ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
              .select("part", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("bytes_before"),
                      F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
                      F.sum("bytes").over(everything).alias("total")))  # one row per partition
    so_far = Window.partitionBy("part").orderBy(*order, "tie").rowsBetween(Window.unboundedPreceding, 0)
    placed = (ranged.withColumn("upto", F.sum("size").over(so_far))
              .withColumn("nth", F.row_number().over(so_far))
              .join(F.broadcast(totals), "part")
              .withColumn("middle2", 2 * (F.col("bytes_before") + F.col("upto")) - F.col("size"))
              .withColumn("shard", F.expr(f"middle2 * {n_shards} div (2 * total)").cast("int"))
              .withColumn("row", F.col("rows_before") + F.col("nth") - 1)
              .select("doc_id", "size", "text_crc32", "shard", "row"))
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first_row"))  # n_shards rows
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first_row")).alias("slot"))
