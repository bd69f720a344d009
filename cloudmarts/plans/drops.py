"""Incremental bronze masters: a run reads only the landing files it has not read before.

A ledger per master names every file by path, time and length, with the drop it came in.  A run
lists the landing folder, takes the files that the ledger does not hold (a replaced file is a new
one), deduplicates their rows, leaves out keys that earlier drops brought, and adds the rest as
one ``_drop=n`` folder; the ledger follows last.  A run killed at any step is repaired by the
next: it sees the same files as drop n again and overwrites that folder.

The row kept for a key is that of the earliest drop, within a drop the first in total order, as
``rebuild`` finds it from all files at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..operators.ingest import dedup_latest
from ..schemas import LANDING
from ..sinks import partition_values, path_exists, read_table, write_table
from ..sources.landing import corrupt_rows, ingest_master

DROP = "_drop"
_FILE = ["path", "modificationTime", "length"]


def landing_files(spark: SparkSession, path: str) -> DataFrame:
    """path, modificationTime, length of the files of a folder (or of one file), listed by Spark;
    no content is read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select(*_FILE))


def _drops(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(v) for v in partition_values(spark, path, DROP)) if path_exists(spark, path) else []


def new_files(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    listed = landing_files(spark, path)
    if not path_exists(spark, ledger):
        return listed
    return listed.join(read_table(spark, ledger, types={DROP: LongType()}).select(*_FILE), _FILE, "left_anti")


def ingest_drop(spark: SparkSession, landing: str, name: str, target: str, quarantine: str, ledger: str) -> dict[str, int]:
    """Bring bronze master ``name`` up to its landing folder; returns files and bytes read, rows
    added and corrupt rows."""
    _schema, keys, part = LANDING[name]
    held, listed = _drops(spark, target), _drops(spark, ledger)
    if listed and not held:
        raise RuntimeError(f"{target} does not hold the drops of its ledger {ledger}; rebuild into a new table")
    drop = len(listed)  # a folder without its ledger row is a killed run's: it is written again
    files = new_files(spark, landing, ledger).collect()  # names of new files only
    if not files:
        return {"files": 0, "bytes": 0, "rows": 0, "corrupt": 0}
    seen = Observation()
    good, bad = ingest_master(spark, [f["path"] for f in files], name, order_by=[F.col("ingest_ts").asc()], seen=seen)
    if drop:
        earlier = read_table(spark, target, types={DROP: LongType()}).where(F.col(DROP) < drop)
        known = earlier.select(*[F.col(f"`{k}`").alias(f"_known_{i}") for i, k in enumerate(keys)])
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"_known_{i}"))
        good = good.join(known, same, "left_anti")
    layout = [DROP, *([part] if part else [])]
    rows = write_table(good.withColumn(DROP, F.lit(drop)), target, layout, dynamic=True)
    corrupt = write_table(corrupt_rows(bad, seen).withColumn(DROP, F.lit(drop)), quarantine, [DROP], dynamic=True)
    ledger_rows = spark.createDataFrame([tuple(f) for f in files], landing_files(spark, landing).schema)
    write_table(ledger_rows.coalesce(1), f"{ledger}/{DROP}={drop}")
    return {"files": len(files), "bytes": sum(f["length"] for f in files), "rows": rows, "corrupt": corrupt}


def master(spark: SparkSession, target: str) -> DataFrame:
    """The bronze rows of an incremental master."""
    part = {"types": {DROP: LongType()}}
    return read_table(spark, target, **part).drop(DROP)


def rebuild(spark: SparkSession, name: str, ledger: str) -> DataFrame:
    """The same master from all files of the ledger at once: by drop, then by total order."""
    _schema, keys, _part = LANDING[name]
    files = read_table(spark, ledger, types={DROP: LongType()})
    paths = [r["path"] for r in files.select("path").distinct().collect()]
    good, _bad = ingest_master(spark, paths, name, deduplicate=False)
    of_file = files.groupBy("path").agg(F.min(DROP).alias(DROP))
    rows = good.join(F.broadcast(of_file), F.col("source_file") == F.col("path")).drop("path")
    return dedup_latest(rows, keys, [F.col(DROP).asc()], exclude_from_tiebreak=["ingest_ts"]).drop(DROP)
