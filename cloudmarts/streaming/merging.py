"""Merging the per-batch folders of the one-pass bronze table.

Every micro-batch leaves a folder of its own, so a long-running stream leaves very many small
files.  Closed batches (older than the last one and without a key that a later batch is compared
with) are merged by ``fanout``, merged folders by ``fanout`` again, so that the number of folders
grows with the logarithm of the number of batches and each row is written again as often.

A merge is committed by one small record, written after the merged rows and before the old folders
go.  Readers (``hidden_batches``) leave out merged folders without a record and folders that a
record has replaced; they see every row once at any step, and a merge that was killed is finished
or done again by the next run.  Replays are safe: the last batch and live ones are never merged.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..sinks import path_exists, read_table, write_table

FANOUT = 16
_MERGED = "merged-"


def _fs(spark: SparkSession, path: str):
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(sc._jsc.hadoopConfiguration()), where


def _folders(spark: SparkSession, path: str, name: str = "*") -> list:
    fs, where = _fs(spark, f"{path}/*/*/_batch={name}")
    return [f.getPath() for f in (fs.globStatus(where) or [])]


def batch_folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the table's batch folders (no file is read)."""
    return sorted({p.getName().split("=", 1)[1] for p in _folders(spark, path)})


def _records(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Committed merges: merged name -> names it replaced."""
    log = f"{path}_merges"
    if not path_exists(spark, log):
        return {}
    rows = spark.read.schema("merged string, replaced array<string>").option("recursiveFileLookup", "true").parquet(log)
    return {r["merged"]: r["replaced"] for r in rows.collect()}


def hidden_batches(spark: SparkSession, path: str) -> list[str]:
    """Folders that a reader must leave out: replaced ones not deleted yet, and merged ones
    without a record."""
    if not path_exists(spark, f"{path}_merges") and not _folders(spark, path, f"{_MERGED}*"):
        return []
    records, there = _records(spark, path), batch_folders(spark, path)
    replaced = {name for names in records.values() for name in names}
    return [n for n in there if n in replaced or (n.startswith(_MERGED) and n not in records)]


def _level(name: str) -> int:
    return int(name.split("-")[1]) if name.startswith(_MERGED) else 0


def clean(spark: SparkSession, path: str) -> int:
    """Delete the folders no reader looks at; returns how many names went."""
    gone = hidden_batches(spark, path)
    fs, _ = _fs(spark, path)
    for name in gone:
        for folder in _folders(spark, path, name):
            fs.delete(folder, True)
    return len(gone)


def merge_closed_batches(spark: SparkSession, path: str, ledger: str, fanout: int = FANOUT,
                         partition_by: str = "service") -> int:
    """Merge the first ``fanout`` closed folders of one level, if there are so many; returns the
    number of folders merged (0: nothing to do).  To be run between runs of the stream."""
    clean(spark, path)
    rows = spark.read.option("recursiveFileLookup", "true").parquet(ledger).select("query", "batch", "open_batches")
    last = rows.orderBy(F.col("batch").desc()).limit(1).head()
    if last is None:
        return 0
    live = {item.split(":")[0] for item in last["open_batches"].split(",") if item} | {f"{last['query']}-{last['batch']}"}
    levels = defaultdict(list)
    for name in batch_folders(spark, path):
        if name not in live:
            levels[_level(name)].append(name)
    for level, names in sorted(levels.items()):
        # in the order of batches: names end with the number of their (last) batch
        names = sorted(names, key=lambda n: int(n.rsplit("-", 1)[1]))[:fanout]
        if len(names) < fanout:
            continue
        merged = f"{_MERGED}{level + 1}-{names[0].rsplit('-', 1)[1]}-{names[-1].rsplit('-', 1)[1]}"
        table = read_table(spark, path, types={"_batch": StringType(), "outcome": StringType(), partition_by: StringType()})
        out = table.where(F.col("_batch").isin(names)).withColumn("_batch", F.lit(merged))
        layout = ["outcome", partition_by, "_batch"]
        write_table(out.hint("rebalance", *layout), path, layout, dynamic=True)
        record = spark.createDataFrame([(merged, names)], "merged string, replaced array<string>")
        write_table(record.coalesce(1), f"{path}_merges/{merged}")
        clean(spark, path)
        return len(names)
    return 0
