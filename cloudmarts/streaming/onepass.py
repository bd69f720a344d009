"""One-pass bronze ingest: every landing row is read once and kept under its outcome.

``bronze_usage_stream`` runs two queries over the landing files and lets the engine's stateful
dedup drop late rows.  Here one query reads each file once, and a micro-batch is one job that
writes one table, ``outcome=/service=/_batch=``:

- ``event``: the bronze rows, one per (event_id, event time);
- ``duplicate``: keys an earlier batch holds already, one row per key;
- ``late``: rows at or before the watermark, with their delay in ``late_by_seconds``;
- ``untimed``: rows without an event time; ``malformed``: lines that do not parse, with their text.

``copies`` tells how many input rows a row stands for, so the sum of ``copies`` over the table is
the number of landing rows, whatever was killed or run again.

The watermark is that of the engine: the largest event time of earlier batches less the delay.
It is kept in a ledger, one row a batch, written after the batch's rows: a batch that is run again
finds the same watermark and the same earlier keys and overwrites its own folders.  Earlier keys
are read from the table itself, from the batches that still hold a time after the watermark; the
state is thus bounded by the delay, as in the engine's dedup.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..sinks import path_exists, read_table, write_table
from ..sources.landing import CORRUPT
from .bronze import MALFORMED, NULL_TIME, UNTIMED
from .merging import hidden_batches

EVENT, DUPLICATE, LATE = "event", "duplicate", "late"
OUTCOMES = (EVENT, DUPLICATE, LATE, UNTIMED, MALFORMED)
LAYOUT = ("outcome", "_batch", "copies", "late_by_seconds")
_LEDGER = StructType([
    StructField("query", StringType()), StructField("batch", LongType()),
    *[StructField(o, LongType()) for o in OUTCOMES],
    StructField("latest", LongType()),   # largest event time (microseconds) up to this batch
    StructField("open_batches", StringType())])  # "batch:latest" of those that may hold live keys


def delay_micros(spark: SparkSession, watermark: str) -> int:
    """Microseconds of an interval text such as "2 hours"."""
    return int(spark.sql(f"SELECT unix_micros(timestamp_micros(0) + INTERVAL '{watermark}') AS d").head()["d"])


def _tagged(batch: DataFrame, time_col: str, late_before: int | None, null_time: str) -> DataFrame:
    """Adds outcome (before dedup), late_by_seconds and _alone, a number of its own for every
    row that is not deduplicated (so that such rows never meet in one task)."""
    micros = F.unix_micros(F.col(time_col).cast("timestamp"))
    late = F.lit(False) if late_before is None else micros <= F.lit(late_before)
    outcome = F.when(F.coalesce(late, F.lit(False)), F.lit(LATE)).otherwise(F.lit(EVENT))
    if null_time == "divert":
        outcome = F.when(F.col(time_col).isNull(), F.lit(UNTIMED)).otherwise(outcome)
    if CORRUPT in batch.columns:
        outcome = F.when(F.col(CORRUPT).isNotNull(), F.lit(MALFORMED)).otherwise(outcome)
    delay = (F.lit(late_before) - micros) / 1e6
    tagged = batch.withColumn("outcome", outcome)
    return tagged.withColumns({
        "late_by_seconds": F.when(F.col("outcome") == LATE, delay if late_before is not None else F.lit(None)).cast("double"),
        "_alone": F.when(F.col("outcome") != EVENT, F.monotonically_increasing_id())})


def _one_per_key(tagged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the first in the order of all its columns, and how many it stands for.
    Partial aggregates: a key with a third of all rows leaves one row a task."""
    whole = F.struct(*[F.col(f"`{c}`") for c in tagged.columns if c not in (*keys, "_alone")])
    rows = tagged.groupBy(*keys, "_alone").agg(F.min(whole).alias("_row"), F.count("*").alias("copies"))
    return rows.select(*keys, "_alone", "copies", "_row.*")


def _earlier_keys(spark: SparkSession, path: str, batches: Sequence[str], keys: Sequence[str], time_col: str,
                  late_before: int | None) -> DataFrame:
    table = read_table(spark, path, types={"service": StringType(), "_batch": StringType(), "outcome": StringType()})
    live = table.where((F.col("outcome") == EVENT) & F.col("_batch").isin(list(batches)))
    if late_before is not None:
        after = F.col(time_col) > F.timestamp_micros(F.lit(late_before))
        live = live.where(F.col(time_col).isNull() | after)
    return live.select(*[F.col(c).alias(f"_earlier_{i}") for i, c in enumerate(keys)], F.lit(True).alias("_seen"))


def ingest_batch(batch: DataFrame, batch_id: int, query: str, path: str, ledger: str,
                 time_col: str = "timestamp_parsed", keys: Sequence[str] = ("event_id",),
                 watermark: str = "2 hours", null_time: str = "divert",
                 partition_by: Sequence[str] = ("service",)) -> dict[str, int]:
    """Write one micro-batch and its ledger row; returns the rows of each outcome.  Running it
    again with the same rows leaves the same table."""
    spark = batch.sparkSession
    before = None
    if batch_id > 0 and path_exists(spark, f"{ledger}/{query}-{batch_id - 1}"):
        before = spark.read.schema(_LEDGER).parquet(f"{ledger}/{query}-{batch_id - 1}").head()
    latest = before["latest"] if before else None
    late_before = None if latest is None else latest // 1000 * 1000 - delay_micros(spark, watermark)
    live = dict(item.split(":") for item in before["open_batches"].split(",") if item) if before else {}
    live = {b: t for b, t in live.items() if null_time == "keep" or int(t) > late_before}
    keyed = [*keys, time_col]
    rows = _one_per_key(_tagged(batch, time_col, late_before, null_time), keyed)
    if live:
        known = _earlier_keys(spark, path, list(live), keyed, time_col, late_before)
        same = F.col("_alone").isNull()
        for i, c in enumerate(keyed):
            same = same & F.col(c).eqNullSafe(F.col(f"_earlier_{i}"))
        rows = rows.join(known, same, "left").withColumn(
            "outcome", F.when(F.col("_seen"), F.lit(DUPLICATE)).otherwise(F.col("outcome")))
        rows = rows.drop("_seen", *[f"_earlier_{i}" for i in range(len(keyed))])
    name = f"{query}-{batch_id}"
    columns = [c for c in batch.columns if c not in partition_by]
    out = rows.select(*columns, "copies", "late_by_seconds", "outcome", *partition_by, F.lit(name).alias("_batch"))
    counts, own = dict.fromkeys(OUTCOMES, 0), None
    if write_table(out, path, ["outcome", *partition_by, "_batch"], dynamic=True):
        # counted from what was written, so the ledger tells what the table holds
        written = read_table(spark, path, types={"_batch": StringType(), "outcome": StringType()}).where(F.col("_batch") == name)
        for r in written.groupBy("outcome").agg(F.sum("copies").alias("n"), F.max(F.unix_micros(
                F.col(time_col).cast("timestamp"))).alias("latest")).collect():
            counts[r["outcome"]] = r["n"]
            if r["outcome"] in (EVENT, DUPLICATE) and r["latest"] is not None:
                own = max(own or r["latest"], r["latest"])
    if own is not None or (null_time == "keep" and counts[EVENT]):
        live[name] = str(own if own is not None else 0)
    latest = max((t for t in (latest, own) if t is not None), default=None)
    row = (query, batch_id, *counts.values(), latest, ",".join(f"{b}:{t}" for b, t in live.items()))
    spark.createDataFrame([row], _LEDGER).coalesce(1).write.mode("overwrite").parquet(f"{ledger}/{name}")
    return counts


def ingest_usage_once(parsed: DataFrame, path: str, ledger: str, checkpoint: str, **options) -> StreamingQuery:
    """Run the one-pass ingest over everything available, then stop.

    Refuses a table whose ledger is another query's: after a lost checkpoint every file would be
    read again under new batch numbers, and rows behind the watermark stored twice.
    """
    if options.get("null_time", "divert") not in NULL_TIME:
        raise ValueError(f"null_time must be one of {NULL_TIME}")
    spark = parsed.sparkSession
    if path_exists(spark, ledger) and not path_exists(spark, f"{checkpoint}/metadata"):
        raise RuntimeError(f"{path} was written by a stream whose checkpoint {checkpoint} is missing; "
                           "restore it, or ingest into a new table")
    group = spark.sparkContext.getLocalProperty("spark.jobGroup.id")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        sc = batch.sparkSession.sparkContext
        if group:  # batches run on the stream thread: keep them in the caller's job group
            sc.setJobGroup(group, group)
        ingest_batch(batch, batch_id, sc.getLocalProperty("sql.streaming.queryId"), path, ledger, **options)

    q = (parsed.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def outcome_rows(spark: SparkSession, path: str, *outcomes: str, types: dict | None = None) -> DataFrame:
    """The rows of some outcomes; only their folders are read, each row once also while
    batches are being merged."""
    hidden = hidden_batches(spark, path)
    table = read_table(spark, path, types={"_batch": StringType(), "outcome": StringType(), **(types or {})})
    rows = table.where(F.col("outcome").isin(list(outcomes)))
    return rows.where(~F.col("_batch").isin(hidden)) if hidden else rows


def landed_counts(spark: SparkSession, ledger: str) -> DataFrame:
    """Input rows of each outcome and of all (``landed``), summed over the ledger."""
    rows = spark.read.schema(_LEDGER).option("recursiveFileLookup", "true").parquet(ledger)
    total = sum((F.col(o) for o in OUTCOMES[1:]), F.col(EVENT))
    return rows.agg(*[F.sum(o).alias(o) for o in OUTCOMES], F.sum(total).alias("landed"))
