"""Running totals per (org, service): any day range of V2 is two reads.

``total`` of a key as of a day is the exact decimal sum of its daily costs up to that day, and
``days`` the number of its daily rows.  The table is laid out by month and bucket.  Besides the
days it has rows for, a key opens every later month with what it carries over, so the total as of
any day stands in that day's month alone: a range costs the rows of two months, however long it
is, and the difference of two totals is its sum.

A refresh takes the keys whose daily rows changed and rewrites their totals from the month of the
earliest changed day on, in their buckets; other buckets and earlier months are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sinks import partition_values, path_exists, read_table, staged, write_table
from .joins import checked_broadcast
from .serving import BUCKET, LAYOUT_TYPES, N_BUCKETS, PERIOD, bucket_of, bucket_of_literal, recorded_buckets

KEY = ["org_id", "service"]
MONEY = "decimal(28,4)"
_ONE_DAY = 1


def _month(day: Column) -> Column:
    return F.trunc(day, "month")


def _cells(daily: DataFrame) -> DataFrame:
    """Keys, day, cost as an exact decimal and its month, of the rows that have a day."""
    return daily.where(F.col("usage_date").isNotNull()).select(
        *KEY, F.col("usage_date").alias("as_of"), F.col("total_cost_usd").cast(MONEY).alias("cost"),
        F.lit(1).alias("rows"), _month(F.col("usage_date")).alias(PERIOD))


def _with_openings(cells: DataFrame, starts: DataFrame, last_month) -> DataFrame:
    """Running totals of ``cells`` and, for every month after a key's first one up to
    ``last_month``, the row it opens the month with (as of the day before).

    ``starts``: keys, first (month), cost and rows carried into it (null: the key is new).
    """
    first = starts.select(*KEY, "first", F.coalesce("cost", F.lit(0)).cast(MONEY).alias("cost"),
                          F.coalesce("rows", F.lit(0)).alias("rows"), F.col("rows").isNotNull().alias("old"))
    months = first.select(*KEY, "first", "cost", "rows", "old", F.explode(F.sequence(
        F.col("first"), F.greatest(F.col("first"), F.lit(last_month).cast("date")), F.expr("INTERVAL 1 MONTH"))).alias(PERIOD))
    at_start = F.col(PERIOD) == F.col("first")
    openings = months.where(~at_start | F.col("old")).select(
        *KEY, F.date_sub(F.col(PERIOD), _ONE_DAY).alias("as_of"), F.when(at_start, F.col("cost")).otherwise(0).cast(MONEY).alias("cost"),
        F.when(at_start, F.col("rows")).otherwise(0).alias("rows"), PERIOD)
    # a month's opening comes after the last day of the month before
    so_far = Window.partitionBy(*KEY).orderBy(PERIOD, "as_of").rowsBetween(Window.unboundedPreceding, 0)
    return cells.unionByName(openings).select(
        *KEY, "as_of", F.sum("cost").over(so_far).cast(MONEY).alias("total"), F.sum("rows").over(so_far).alias("days"), PERIOD)


def refresh_running_totals(spark: SparkSession, path: str, daily: DataFrame, changed: DataFrame | None = None,
                           n_buckets: int = 64) -> int:
    """Bring the totals at ``path`` up to the stored daily table ``daily``
    (``serving.open_serving``) after its rows ``changed`` (keys and usage_date) were upserted;
    without ``changed``, or without a table, they are made whole.  Returns the rows written.

    Rows without a day count in no total.  Running it again changes nothing.
    """
    if changed is None or not path_exists(spark, path):
        cells = _cells_of(daily)
        starts = cells.groupBy(*KEY).agg(F.min(PERIOD).alias("first")).select(
            *KEY, "first", F.lit(None).cast(MONEY).alias("cost"), F.lit(None).cast("long").alias("rows"))
        last = cells.agg(F.max(PERIOD)).head()[0]
        if last is None:
            return 0
        rows = _laid_out(_with_openings(cells, starts, last), n_buckets)
        return write_table(rows.hint("rebalance", PERIOD, BUCKET), path, [PERIOD, BUCKET], sort_within=KEY + ["as_of"])
    table = read_table(spark, path, types=LAYOUT_TYPES)
    if recorded_buckets(table) != n_buckets:
        raise ValueError(f"{path} is not laid out in {n_buckets} buckets")
    touched = staged(changed.where(F.col("usage_date").isNotNull()).groupBy(*KEY)
                     .agg(_month(F.min("usage_date")).alias("first"), _month(F.max("usage_date")).alias("last"))
                     .withColumn(BUCKET, bucket_of(["org_id"], n_buckets)),
                     "totals-touched")
    bounds = touched.agg(F.min("first").alias("low"), F.max("last").alias("high"), F.collect_set(BUCKET).alias("buckets")).head()
    if bounds["low"] is None:
        return 0
    stored_last = max(partition_values(spark, path, PERIOD))
    last = max(stored_last, str(bounds["high"]))  # the changed rows may bring new months
    low, buckets = bounds["low"], sorted(bounds["buckets"])
    mine = checked_broadcast(touched.select(*KEY, "first"))
    # what each touched key carried into its first changed month
    opening = (table.where((F.col(PERIOD) >= F.lit(low)) & F.col(BUCKET).isin(buckets)).join(mine, KEY)
               .where((F.col(PERIOD) == F.col("first")) & (F.col("as_of") < F.col("first")))
               .select(*KEY, F.col("total").alias("cost"), F.col("days").alias("rows")))
    starts = touched.select(*KEY, "first").join(opening, KEY, "left")
    # a key first seen before a month it has no opening row for (a month newer than the table)
    newer = starts.where(F.col("rows").isNull() & (F.col("first") > F.lit(stored_last).cast("date"))).select(*KEY)
    carried = (table.where((F.col(PERIOD) == F.lit(stored_last).cast("date")) & F.col(BUCKET).isin(buckets))
               .groupBy(*KEY).agg(F.max_by("total", F.struct("as_of")).alias("carried"), F.max("days").alias("carried_days")))
    starts = (starts.join(newer.join(carried, KEY), KEY, "left")
              .select(*KEY, "first", F.coalesce("cost", "carried").alias("cost"), F.coalesce("rows", "carried_days").alias("rows")))
    in_layout = F.col(BUCKET).isin(buckets) & (F.col(PERIOD) >= F.lit(low)) if BUCKET in daily.columns else F.lit(True)
    cells = (_cells_of(daily.where(in_layout)).join(mine, KEY).where(F.col(PERIOD) >= F.col("first")).drop("first"))
    fresh = _laid_out(_with_openings(cells, starts, last), n_buckets)
    kept = (table.where((F.col(PERIOD) >= F.lit(low)) & F.col(BUCKET).isin(buckets))
            .join(mine.withColumnRenamed("first", "from_month"), KEY, "left")
            .where(F.col("from_month").isNull() | (F.col(PERIOD) < F.col("from_month"))).drop("from_month"))
    out = kept.unionByName(fresh)
    if last > stored_last:  # keys that did not change open the new months as well
        still = (table.where(F.col(PERIOD) == F.lit(stored_last).cast("date")).groupBy(*KEY)
                 .agg(F.max_by("total", "as_of").alias("total"), F.max("days").alias("days"))
                 .join(mine.select(*KEY), KEY, "left_anti"))
        late = touched.where(F.col("first") > F.lit(stored_last).cast("date")).select(*KEY, "first")
        idle = still.select(*KEY, "total", "days", F.explode(F.sequence(
            F.add_months(F.lit(stored_last).cast("date"), 1), F.lit(last).cast("date"), F.expr("INTERVAL 1 MONTH"))).alias(PERIOD))
        # a touched key's months between the stored ones and its first changed one
        gap = (carried.join(late, KEY).withColumn(PERIOD, F.explode(F.sequence(
            F.add_months(F.lit(stored_last).cast("date"), 1), F.col("first"), F.expr("INTERVAL 1 MONTH"))))
            .where(F.col(PERIOD) < F.col("first")).select(*KEY, F.col("carried").alias("total"), F.col("carried_days").alias("days"), PERIOD))
        out = out.unionByName(_laid_out(idle.unionByName(gap).withColumn("as_of", F.date_sub(F.col(PERIOD), _ONE_DAY)), n_buckets))
    stage = scratch_path(spark, "totals-merged")
    write_table(out.hint("rebalance", PERIOD, BUCKET), stage, [PERIOD, BUCKET], sort_within=KEY + ["as_of"])
    return write_table(read_table(spark, stage, out.schema), path, [PERIOD, BUCKET], dynamic=True, sort_within=KEY + ["as_of"])


def _cells_of(daily: DataFrame) -> DataFrame:
    """``_cells`` of a stored daily table: its month column prunes the read."""
    return _cells(daily.drop(PERIOD, BUCKET, N_BUCKETS))


def _laid_out(rows: DataFrame, n_buckets: int) -> DataFrame:
    return rows.select(*KEY, "as_of", F.col("total").cast(MONEY).alias("total"), F.col("days").cast("long").alias("days"),
                       F.lit(n_buckets).alias(N_BUCKETS), PERIOD, bucket_of(["org_id"], n_buckets).alias(BUCKET))


def range_totals(spark: SparkSession, path: str, start: str, end: str, org_id=None) -> DataFrame:
    """V2's sums: org_id, service, cumulative_cost_usd of the keys with rows in [start, end], from
    the two months that hold ``end`` and the day before ``start``."""
    table = read_table(spark, path, types=LAYOUT_TYPES)
    if org_id is not None:
        same = bucket_of_literal(org_id, recorded_buckets(table), table.schema["org_id"].dataType)
        table = table.where((F.col(BUCKET) == same) & (F.col("org_id") == F.lit(org_id)))
    months = sorted(partition_values(spark, path, PERIOD))
    before = str(spark.sql(f"SELECT DATE '{start}' - {_ONE_DAY} AS d").head()["d"])
    sides, where = {}, F.lit(False)
    for name, day in (("upto", end), ("before", before)):
        at = [m for m in months if m <= day]  # the newest month begun by then; later ones carry nothing more
        sides[name] = F.lit(False)
        if at:
            sides[name] = (F.col(PERIOD) == F.lit(at[-1]).cast("date")) & (F.col("as_of") <= F.lit(day).cast("date"))
            where = where | sides[name]
    picked = table.where(where).groupBy(*KEY).agg(*[
        F.max_by(F.when(sides[n], F.struct("total", "days")), F.when(sides[n], F.struct("as_of", "days"))).alias(n) for n in sides])
    total = F.col("upto.total") - F.coalesce("before.total", F.lit(0).cast(MONEY))
    return (picked.where(F.col("upto.days") > F.coalesce("before.days", F.lit(0)))
            .select(*KEY, total.cast("double").alias("cumulative_cost_usd")))


def top_services(sums: DataFrame, top_n: int | None = None) -> DataFrame:
    """O1: ranked per org as ``serving.top_services`` does."""
    w = Window.partitionBy("org_id").orderBy(F.col("cumulative_cost_usd").desc(), F.col("service"))
    ranked = sums.withColumn("cost_rank", F.row_number().over(w).cast("bigint"))
    return ranked.filter(F.col("cost_rank") <= top_n) if top_n else ranked
