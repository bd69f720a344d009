"""Structured Streaming bronze ingest and incremental daily-mart refresh.

Usage events arrive as files.  The stream parses event time, deduplicates on
(event_id, event time) under a watermark -- event time is part of the key, so
state older than the watermark is evicted -- and appends to a parquet table
partitioned by service, exactly once through the checkpoint.  Lines that do not
parse and (by default) rows without an event time, whose state would never be
evicted, go to a side table with their reason and raw text, by a second,
stateless query.

``refresh_daily_from_stream`` keeps the daily serving table current: every
micro-batch appends its events to an events table (idempotent per batch), then
recomputes whole days it touched from that table and upserts them, so a key
spanning micro-batches is never replaced by a partial sum.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StringType, StructType

from ..operators.ingest import dedup_latest
from ..operators.serving import upsert_table
from ..sinks import path_exists, read_table, write_table
from ..sources.landing import CORRUPT, with_corrupt

NULL_TIME = ("divert", "keep")
MALFORMED, UNTIMED = "malformed", "untimed"


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "json",
                max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """Files in ``path`` (a directory) as a stream, with a declared schema; ``glob`` keeps
    other files of the folder out.  A malformed JSON line keeps its text in ``_corrupt``."""
    r = spark.readStream.format(fmt)
    if fmt == "json":
        schema = with_corrupt(schema)
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.schema(schema).load(path)


def check_restart(spark: SparkSession, path: str, checkpoint: str) -> None:
    """Refuse to start on a table that a stream has written while its checkpoint is gone.
    A new checkpoint numbers its batches from 0, and the table's own log would skip them
    silently, along with every file that has arrived since."""
    if path_exists(spark, f"{path}/_spark_metadata") and not path_exists(spark, f"{checkpoint}/metadata"):
        raise RuntimeError(f"{path} was written by a stream whose checkpoint {checkpoint} is missing; "
                           "restore it, or ingest into a new table")


def dedup_events(df: DataFrame, time_col: str = "timestamp_parsed",
                 keys: Sequence[str] = ("event_id",), watermark: str = "2 hours",
                 within_watermark: bool = False) -> DataFrame:
    """Watermark + stateful dedup.  Rows older than the watermark are
    dropped (reported as ``numRowsDroppedByWatermark``).

    Default key: ``keys`` plus event time (a re-sent event with the same time is a
    duplicate).  ``within_watermark=True`` keys on ``keys`` alone and keeps each key's
    state for the watermark delay, so a re-send with a shifted timestamp is caught too.
    """
    w = df.withWatermark(time_col, watermark)
    if within_watermark:
        return w.dropDuplicatesWithinWatermark(list(keys))
    return w.dropDuplicates([*keys, time_col])


def run_available_now(df: DataFrame, path: str, checkpoint: str,
                      partition_by: Sequence[str] = (), fmt: str = "parquet") -> StreamingQuery:
    """Append everything available now, then stop."""
    check_restart(df.sparkSession, path, checkpoint)
    w = (df.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", path)
         .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    q = w.start()
    q.awaitTermination()
    return q


def bronze_usage_stream(parsed: DataFrame, out_path: str, checkpoint: str,
                        side_path: str | None = None, null_time: str = "divert",
                        time_col: str = "timestamp_parsed", keys: Sequence[str] = ("event_id",),
                        watermark: str = "2 hours",
                        partition_by: Sequence[str] = ("service",)) -> list[StreamingQuery]:
    """Run the bronze stream(s) to completion; returns the finished queries.

    Side rows go to ``side_path`` with a ``reason``: ``malformed`` lines (raw text in
    ``_corrupt``) always, rows without event time as ``untimed`` under
    ``null_time="divert"``.  With ``"keep"`` untimed rows are deduplicated with the rest
    (their state is never evicted).  ``side_path`` may be left out only where neither occurs:
    ``"keep"`` on a source without a ``_corrupt`` column.
    """
    if null_time not in NULL_TIME:
        raise ValueError(f"null_time must be one of {NULL_TIME}")
    reason = F.lit(None).cast("string")
    if null_time == "divert":
        reason = F.when(F.col(time_col).isNull(), F.lit(UNTIMED))
    if CORRUPT in parsed.columns:
        reason = F.when(F.col(CORRUPT).isNotNull(), F.lit(MALFORMED)).otherwise(reason)
    queries = []
    good = parsed
    if null_time == "divert" or CORRUPT in parsed.columns:
        if side_path is None:
            raise ValueError("side_path is required for rows that are left out of bronze")
        marked = parsed.withColumn("reason", reason)
        good = marked.filter(F.col("reason").isNull()).drop("reason", CORRUPT)
        side = marked.filter(F.col("reason").isNotNull())
        queries.append(run_available_now(side, side_path, checkpoint.rstrip("/") + "-side"))
    queries.append(run_available_now(dedup_events(good, time_col, keys, watermark),
                                     out_path, checkpoint, partition_by))
    return queries


def rows_dropped_by_watermark(q: StreamingQuery) -> int:
    """Late rows dropped over the query's recent progress (0 if none reported)."""
    total = 0
    for p in q.recentProgress:
        for op in p.stateOperators or []:
            total += int(getattr(op, "numRowsDroppedByWatermark", 0) or 0)
    return total


def refresh_daily_from_stream(
        spark: SparkSession, parsed: DataFrame, events_path: str, serving_path: str,
        checkpoint: str, build_daily: Callable[[DataFrame], DataFrame],
        side_path: str | None = None,
        keys: Sequence[str] = ("org_id", "service", "usage_date"),
        time_col: str = "timestamp_parsed", watermark: str = "2 hours",
        n_buckets: int = 64, mode: str = "recompute",
        finish_daily: Callable[[DataFrame], DataFrame] | None = None) -> list[StreamingQuery]:
    """Incremental refresh of the daily serving table from a usage stream.

    ``mode="recompute"``: ``build_daily(events)`` maps raw events to daily rows.  Per
    micro-batch: (1) write the batch's events under a partition named by the query's id (it
    lives in the checkpoint) and the batch number, so a replayed batch overwrites itself and
    a new checkpoint never overwrites an older one's rows, (2) take the days it touched,
    (3) recompute those whole days from the events table, deduplicated by key, (4) upsert
    them.  Cost per batch grows with the size of the touched days.

    ``mode="partials"`` (for large days): ``build_daily`` returns additive partial sums,
    which are stored instead of the events, and ``finish_daily`` re-sums and rounds them.
    Only partials of the running query's id are summed: after a lost checkpoint the new
    query reads every file again, and the old sums must not be added to its own.

    State stays bounded: the only stateful step is the watermarked dedup.

    Malformed lines and rows without event time have no day; a second, stateless query
    writes them to ``side_path`` with their reason (required unless it is known that there
    are none: without it such rows are refused by failing the stream).
    """
    if mode not in ("recompute", "partials"):
        raise ValueError("mode must be 'recompute' or 'partials'")
    if mode == "partials" and finish_daily is None:
        raise ValueError("mode='partials' needs finish_daily")
    group = spark.sparkContext.getLocalProperty("spark.jobGroup.id")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        sc = batch.sparkSession.sparkContext
        if group:  # batches run on the stream thread: keep them in the caller's job group
            sc.setJobGroup(group, group)
        query = sc.getLocalProperty("sql.streaming.queryId")
        name = f"{query}-{batch_id}"
        if mode == "partials":
            b = build_daily(batch)
        else:
            b = batch.withColumn("usage_date", F.to_date(F.col(time_col)))
        if write_table(b.withColumn("_batch", F.lit(name)), events_path, ["usage_date", "_batch"],
                       dynamic=True) == 0:
            return
        table = read_table(spark, events_path, types={"usage_date": DateType(), "_batch": StringType()})
        # days of the batch just written, read from its partitions (bounded by the days one
        # batch spans), not from a second evaluation of the micro-batch
        touched = sorted(r[0] for r in table.filter(F.col("_batch") == name)
                                            .select("usage_date").distinct().collect())
        # static partition filter: only the touched days are read
        rows = table.filter(F.col("usage_date").isin(touched))
        if mode == "partials":
            daily = finish_daily(rows.filter(F.col("_batch").startswith(f"{query}-")).drop("_batch"))
        else:
            daily = build_daily(dedup_latest(rows.drop("usage_date", "_batch"), ["event_id", time_col]))
        upsert_table(spark, serving_path, daily, list(keys), n_buckets=n_buckets,
                     period_col="usage_date")

    bad = F.col(time_col).isNull()
    if CORRUPT in parsed.columns:
        bad = bad | F.col(CORRUPT).isNotNull()
    queries = []
    if side_path is not None:
        reason = F.lit(UNTIMED)
        if CORRUPT in parsed.columns:
            reason = F.when(F.col(CORRUPT).isNotNull(), F.lit(MALFORMED)).otherwise(reason)
        queries.append(run_available_now(parsed.filter(bad).withColumn("reason", reason), side_path,
                                         checkpoint.rstrip("/") + "-side"))
        timed = parsed.filter(~bad)
    else:
        timed = parsed.filter(F.when(bad, F.raise_error(F.lit("a row has no event time; give side_path")))
                              .otherwise(F.lit(True)).cast("boolean"))
    deduped = dedup_events(timed.drop(CORRUPT), time_col, watermark=watermark)
    q = (deduped.writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return [*queries, q]
