"""Anomaly flags inside the stream, with fences that move on between batches.

Each micro-batch is joined with the fences made from all batches before it, written with its
flags, and then added to the stored (service, day) sketches, from which the next fences follow.
Fences are versions named like the batch that made them, so a batch that is run again meets the
fences it met before, and every step overwrites its own output.  A batch without rows leaves the
fences as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StringType

from ..operators.anomaly import flag_anomalies, iqr_bounds, sketched_quantiles
from ..operators.joins import checked_broadcast
from ..operators.sketches import SKETCH_K, range_sketches, sketch_quantiles, write_day_sketches
from ..sinks import path_exists, read_table, staged, write_table

_SHARES = {"q1": 0.25, "q3": 0.75}
_FENCES = "service string, n long, q1 double, q3 double, iqr double, upper_bound double, lower_bound double"


def fences_after(spark: SparkSession, sketches: str, k: int, last_days: int | None,
                 events: DataFrame | None = None) -> DataFrame:
    """Fences from the stored sketches, of the newest ``last_days`` days or of all.  With the
    ``events`` that were sketched the quartiles are exact also for services of more than ``k``
    events: the sketches bound them, and one pass over cost and service settles them."""
    first = None
    if last_days is not None:
        newest = read_table(spark, sketches, types={"usage_date": DateType()}).agg(F.max("usage_date")).head()[0]
        first = None if newest is None else spark.sql(f"SELECT DATE '{newest}' - {last_days - 1} AS d").head()["d"]
    merged = range_sketches(spark, sketches, first, k=k)
    if events is None:
        quartiles = sketch_quantiles(merged, _SHARES)
    else:
        merged = staged(merged, "fence-sketches")
        days = F.col("usage_date").isNotNull() if first is None else F.col("usage_date") >= F.lit(first)
        quartiles = merged.select("service", "n").join(
            sketched_quantiles(events.where(days), merged, "daily_cost_usd", "service", _SHARES, k), "service")
    return iqr_bounds(quartiles).select(*[c.split()[0] for c in _FENCES.split(", ")])


def flag_batch(features: DataFrame, batch_id: int, query: str, root: str, k: int = SKETCH_K,
               last_days: int | None = None, exact: bool = False) -> None:
    """Flag one batch of usage features (with ``usage_date``, ``service``, ``daily_cost_usd``)
    under ``root``: events, sketches and fences.  Without earlier fences nothing is flagged.
    ``exact`` settles the quartiles by the stored events of all batches (see ``fences_after``)."""
    spark, name = features.sparkSession, f"{query}-{batch_id}"
    known = f"{root}/fences/{query}-{batch_id - 1}"
    bounds = (spark.read.schema(_FENCES).parquet(known) if path_exists(spark, known)
              else spark.createDataFrame([], _FENCES)).select("service", "upper_bound", "lower_bound")
    flagged = flag_anomalies(features, bounds=checked_broadcast(bounds)).withColumn("_batch", F.lit(name))
    sketched, events = 0, None
    if write_table(flagged, f"{root}/events", ["_batch"], dynamic=True):
        # what was written is read for the sketches, not the batch a second time
        rows = read_table(spark, f"{root}/events", types={"_batch": StringType()})
        sketched = write_day_sketches(rows.where(F.col("_batch") == name), f"{root}/sketches", name, k=k)
    if sketched or path_exists(spark, known):  # else no event has been sketched yet
        if exact:
            events = read_table(spark, f"{root}/events", types={"_batch": StringType()})
        write_table(fences_after(spark, f"{root}/sketches", k, last_days, events).coalesce(1), f"{root}/fences/{name}")


def flag_stream(features: DataFrame, root: str, checkpoint: str, k: int = SKETCH_K,
                last_days: int | None = None, exact: bool = False) -> StreamingQuery:
    """Flag everything available in a stream of usage features, then stop.  Refuses a table that
    a stream has written whose checkpoint is gone, as its batches would be added twice."""
    spark = features.sparkSession
    if path_exists(spark, f"{root}/events") and not path_exists(spark, f"{checkpoint}/metadata"):
        raise RuntimeError(f"{root} was written by a stream whose checkpoint {checkpoint} is missing")
    group = spark.sparkContext.getLocalProperty("spark.jobGroup.id")

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        sc = batch.sparkSession.sparkContext
        if group:
            sc.setJobGroup(group, group)
        flag_batch(batch, batch_id, sc.getLocalProperty("sql.streaming.queryId"), root, k, last_days, exact)

    q = (features.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def flagged_events(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, f"{root}/events", types={"_batch": StringType()}).drop("_batch")
