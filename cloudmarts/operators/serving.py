"""Keyed serving tables, their queries and the idempotency check.

A serving table is a parquet table with a declared unique key, bucketed on its
partition key (``org_id``) into hive partitions ``_bucket=k``.  A point or range
read on one org prunes to one bucket; an upsert rewrites only the buckets its
incoming rows touch.  Everything stays in Spark: no row is fetched to the
driver, rankings are window functions over all orgs at once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, DateType, LongType, MapType, NumericType, StringType,
)

from ..functions.conform import date_from_text, number_or_zero, round_map_values
from ..session import scratch_path
from ..sinks import read_table, staged, try_read_table, write_table
from .ingest import dedup_latest

BUCKET = "_bucket"
N_BUCKETS = "_n_buckets"   # the table's bucket count, stored as a constant column
PERIOD = "_period"         # optional month partition in front of the bucket
DEFAULT_BUCKETS = 64
LAYOUT_TYPES = {BUCKET: LongType(), PERIOD: DateType()}


# --- K4: null fill and last-write-wins merge ----------------------------------------------
def fill_for_serving(df: DataFrame, date_cols: Sequence[str] = (),
                     keys: Sequence[str] = ("org_id",)) -> DataFrame:
    """K4a-d, F13, F14: NULL numerics -> 0 of their type, NULL collections -> empty,
    text dates in ``date_cols`` -> DATE.  Key columns are never filled."""
    cols = {}
    for f in df.schema.fields:
        if f.name in keys and f.name not in date_cols:
            continue
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if f.name in date_cols and isinstance(t, StringType):
            cols[f.name] = date_from_text(f.name)
        elif f.name in date_cols and not isinstance(t, DateType):
            cols[f.name] = F.to_date(c)
        elif isinstance(t, NumericType):
            cols[f.name] = number_or_zero(f.name, t)
        elif isinstance(t, ArrayType):
            cols[f.name] = F.coalesce(c, F.array().cast(t))
        elif isinstance(t, MapType):
            cols[f.name] = F.coalesce(c, F.create_map().cast(t))
    return df.withColumns(cols) if cols else df


def upsert(existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str],
           version_col: str | None = None) -> DataFrame:
    """Rows of ``incoming`` replace rows of ``existing`` with the same key; other
    existing rows are kept (an upsert never deletes).  Duplicate incoming keys keep
    the highest ``version_col``, then a total order, so reruns are identical."""
    inc = incoming.withColumn("__src", F.lit(1))
    if existing is None:
        merged = inc
    else:
        merged = existing.withColumn("__src", F.lit(0)).unionByName(inc, allowMissingColumns=True)
    order = [F.col("__src").desc()]
    if version_col:
        order.append(F.col(version_col).desc_nulls_last())
    return dedup_latest(merged, keys, order).drop("__src")


def bucket_of(partition_key: Sequence[str], n_buckets: int = DEFAULT_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in partition_key]), F.lit(n_buckets))


def upsert_table(spark: SparkSession, path: str, incoming: DataFrame, keys: Sequence[str],
                 partition_key: Sequence[str] = ("org_id",), n_buckets: int = DEFAULT_BUCKETS,
                 order: Sequence[Column] = (), version_col: str | None = None,
                 period_col: str | None = None) -> int:
    """Merge ``incoming`` into the serving table at ``path``; returns rows rewritten.

    Layout: hive partitions ``_bucket=k`` (hash of the partition key), preceded by
    ``_period=<month>`` when ``period_col`` (a DATE key column) is given.  With a period,
    a load that touches recent days of many orgs rewrites only those months' buckets,
    not the table's history, and range reads prune by month.

    1. stage the incoming rows once, tagged with their layout partition (the incoming
       lineage is computed exactly once); a first load goes to the target directly;
    2. list the touched partitions -- at most months x ``n_buckets`` small values, the
       only values that reach the driver;
    3. read just those partitions of the table (static partition pruning), merge, and
       stage the result under the shared checkpoint folder;
    4. dynamic-overwrite those partitions from the stage.
    A failure in step 4 is repaired by rerunning it: the stage holds the merged
    partitions and the overwrite is per partition.  The bucket count and the period
    layout are checked against the existing table (a different bucket count would
    scatter a key over two buckets).  Rows without a date have a partition of their own.
    """
    layout = ([PERIOD] if period_col else []) + [BUCKET]
    cols = {BUCKET: bucket_of(partition_key, n_buckets), N_BUCKETS: F.lit(n_buckets)}
    if period_col:
        cols[PERIOD] = F.trunc(F.col(period_col).cast("date"), "month")
    tagged = incoming.withColumns(cols)
    existing = try_read_table(spark, path, types=LAYOUT_TYPES)
    if existing is None:  # REBALANCE: about one file per partition, a hot one split by AQE
        return write_table(upsert(None, tagged, keys, version_col).hint("rebalance", *layout), path,
                           layout, sort_within=list(order))
    recorded = recorded_buckets(existing)
    if recorded is not None and recorded != n_buckets:
        raise ValueError(f"{path} is laid out in {recorded} buckets, not {n_buckets}")
    if (PERIOD in existing.columns) != bool(period_col):
        raise ValueError(f"{path}: period layout differs from the existing table")
    stage_in = scratch_path(spark, "upsert-incoming")
    if write_table(tagged.hint("rebalance", *layout), stage_in, layout) == 0:
        return 0
    inc = read_table(spark, stage_in, tagged.schema)
    touched = [tuple(r) for r in inc.select(*layout).distinct().collect()]
    merged = upsert(existing.filter(touched_predicate(layout, touched)), inc, keys, version_col)
    stage = scratch_path(spark, "upsert-merged")
    write_table(merged.hint("rebalance", *layout), stage, layout, sort_within=list(order))
    # the stage is already laid out per partition: copy it without another shuffle
    return write_table(read_table(spark, stage, merged.schema), path, layout, dynamic=True,
                       sort_within=list(order))


def touched_predicate(layout: list[str], touched: list[tuple]) -> Column:
    """Partition predicate selecting exactly the touched partitions: the buckets, or per
    month (also the missing one) its list of buckets."""
    if len(layout) == 1:
        return F.col(layout[0]).isin(sorted(t[0] for t in touched))
    by_month: dict = {}
    for month, bucket in touched:
        by_month.setdefault(month, []).append(bucket)
    pred = F.lit(False)
    for month, buckets in sorted(by_month.items(), key=lambda x: (x[0] is not None, x[0])):
        here = F.col(layout[0]).isNull() if month is None else F.col(layout[0]) == F.lit(month)
        pred = pred | (here & F.col(layout[1]).isin(sorted(buckets)))
    return pred


def drop_layout(df: DataFrame) -> DataFrame:
    """The serving rows without the layout columns."""
    return df.drop(BUCKET, N_BUCKETS, PERIOD)


def open_serving(spark: SparkSession, path: str) -> DataFrame:
    """The stored table with its layout columns, which prune point and range reads."""
    return read_table(spark, path, types=LAYOUT_TYPES)


def read_serving(spark: SparkSession, path: str) -> DataFrame:
    return drop_layout(open_serving(spark, path))


def recorded_buckets(table: DataFrame) -> int | None:
    """The bucket count a stored table was written with (one row is read); None if empty."""
    row = table.select(N_BUCKETS).limit(1).first()
    return None if row is None else row[0]


def point_filter(df: DataFrame, n_buckets: int | None = None, **eq) -> DataFrame:
    """Equality filter on key columns; on a stored serving table with ``org_id`` given,
    the bucket predicate prunes partitions to one.  The bucket count is the table's own;
    a different ``n_buckets`` is refused, since it would miss rows."""
    out = df
    if BUCKET in df.columns and eq.get("org_id") is not None:
        recorded = recorded_buckets(df)
        if n_buckets is not None and recorded is not None and recorded != n_buckets:
            raise ValueError(f"the table is laid out in {recorded} buckets, not {n_buckets}")
        if recorded is not None:
            key_type = df.schema["org_id"].dataType
            out = out.filter(F.col(BUCKET) == bucket_of_literal(eq["org_id"], recorded, key_type))
    for k, v in eq.items():
        if v is not None:
            out = out.filter(F.col(k) == F.lit(v))
    return out


def bucket_of_literal(value, n_buckets: int, key_type=None) -> Column:
    """Bucket of a key value; cast to the key column's type first, since the hash of
    an INT 7 differs from that of a BIGINT 7."""
    lit = F.lit(value) if key_type is None else F.lit(value).cast(key_type)
    return F.pmod(F.xxhash64(lit), F.lit(n_buckets))


# --- K6, S11, S12, I1 -------------------------------------------------------------------
def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """K6: keys held by more than one row (empty for a valid serving table)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def footer_counts(spark: SparkSession, paths: Mapping[str, str], by_month: bool = False) -> DataFrame:
    """table_name, n_rows of stored tables from their parquet footers: the count is
    pushed into the scan (DSv2 aggregate push-down), so no data page is read.  ``by_month`` counts
    each month partition (``_period``).

    The scan needs settings of its own, so the result belongs to a session of its own; an empty
    table counts 0.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    out = None
    for name, path in paths.items():
        table = open_serving(own, path)
        if by_month:  # the push-down wants all partition columns; their counts are then summed
            counts = table.groupBy(PERIOD, BUCKET).agg(F.count(F.lit(1)).alias("n"))
            counts = counts.groupBy(PERIOD).agg(F.sum("n").alias("n_rows"))
        else:
            counts = table.agg(F.count(F.lit(1)).alias("n_rows"))
        counts = counts.select(
            F.lit(name).alias("table_name"), *([PERIOD] if by_month else []), "n_rows")
        out = counts if out is None else out.unionByName(counts)
    return out


def sample_key(df: DataFrame, cols: Sequence[str] = ("org_id", "service")) -> DataFrame:
    """One existing key, chosen deterministically (TakeOrderedAndProject)."""
    return df.select(*cols).orderBy(*cols).limit(1)


def row_hash(df: DataFrame) -> Column:
    """xxhash64 of every column; maps enter as their sorted entry arrays."""
    parts = []
    for f in sorted(df.schema.fields, key=lambda f: f.name):
        if f.name in (BUCKET, N_BUCKETS, PERIOD, "__run"):
            continue
        c = F.col(f"`{f.name}`")
        parts.append(F.array_sort(F.map_entries(c)) if isinstance(f.dataType, MapType) else c)
    return F.xxhash64(*parts).cast("decimal(38,0)")


def idempotency_report(existing: DataFrame | None, incoming: DataFrame,
                       keys: Sequence[str], table: str) -> DataFrame:
    """``upsert(upsert(t, x), x)`` against ``upsert(t, x)`` by count, key
    uniqueness and an order-free content hash (a count alone misses changed values).

    The incoming load and the first result are computed once (staged); both results are
    tagged and summarised in one aggregate.
    """
    incoming = staged(incoming, "idempotency-incoming")
    once = staged(upsert(existing, incoming, keys), "idempotency-once")
    twice = upsert(once, incoming, keys)
    both = once.withColumn("__run", F.lit(1)).unionByName(twice.withColumn("__run", F.lit(2)))
    run1, run2 = F.col("__run") == 1, F.col("__run") == 2
    h = row_hash(both)
    key = F.struct(*[F.col(k) for k in keys])
    s = both.agg(
        F.count_if(run1).alias("rows_once"),
        F.count_if(run2).alias("rows_twice"),
        F.count_distinct(F.when(run1, key)).alias("keys_once"),
        F.sum(F.when(run1, h)).alias("h1"),
        F.sum(F.when(run2, h)).alias("h2"),
    )
    return s.select(F.lit(table).alias("table_name"), "rows_once", "rows_twice",
                    (F.col("rows_once") == F.col("keys_once")).alias("keys_unique"),
                    F.coalesce(F.col("h1") == F.col("h2"), F.lit(True)).alias("content_equal"))


# --- serving views of the marts (K4a-d) -----------------------------------------------------
def usage_serving(daily: DataFrame) -> DataFrame:
    return fill_for_serving(daily.select(
        "org_id", "service", "usage_date", "total_cost_usd", "total_requests", "total_cpu_hours",
        "total_storage_gb_hours", "total_genai_tokens", "total_carbon_kg"), ["usage_date"])


def tickets_serving(tickets_day: DataFrame) -> DataFrame:
    return fill_for_serving(tickets_day, ["ticket_date"])


def revenue_serving(revenue: DataFrame) -> DataFrame:
    return fill_for_serving(revenue, ["month"])


def profile_serving(profile: DataFrame) -> DataFrame:
    return fill_for_serving(profile)


# --- V1-V6, O1-O3 -----------------------------------------------------------------------------
def _between(col: str, start: str, end: str) -> Column:
    """Closed range on DATE values (never string comparison)."""
    return F.col(col).between(F.lit(start).cast("date"), F.lit(end).cast("date"))


def _in_range(df: DataFrame, col: str, start: str, end: str) -> DataFrame:
    """Closed date range; on a raw serving table with a month layout the same range
    on ``_period`` prunes partitions."""
    out = df.filter(_between(col, start, end))
    if PERIOD in df.columns:
        lo = F.trunc(F.lit(start).cast("date"), "month")
        out = out.filter(F.col(PERIOD).between(lo, F.lit(end).cast("date")))
    return out


def daily_range(usage: DataFrame, start: str, end: str, org_id=None, service=None) -> DataFrame:
    """V1: daily cost and requests per (org, service) in [start, end]."""
    return (_in_range(point_filter(usage, org_id=org_id, service=service), "usage_date", start, end)
            .select("org_id", "service", "usage_date", "total_cost_usd", "total_requests"))


def newest_first(df: DataFrame, partition_cols: Sequence[str], date_col: str,
                 n: int) -> DataFrame:
    """O2: the ``n`` newest rows per partition key, ranked (per-task pre-limit)."""
    w = Window.partitionBy(*partition_cols).orderBy(F.col(date_col).desc())
    return (df.withColumn("row_rank", F.row_number().over(w).cast("bigint"))
              .filter(F.col("row_rank") <= n))


def top_services(usage: DataFrame, start: str, end: str, org_id=None,
                 top_n: int | None = None) -> DataFrame:
    """V2 + A17 + O1: services ranked by cost summed over [start, end], per org.

    The sum is rounded to 4 dp (the display precision) before ranking; ties go to the
    service name, ascending.  No cut-off unless ``top_n`` is given.
    """
    sums = (_in_range(point_filter(usage, org_id=org_id), "usage_date", start, end)
            .groupBy("org_id", "service")
            .agg(F.round(F.sum("total_cost_usd"), 4).alias("cumulative_cost_usd")))
    w = Window.partitionBy("org_id").orderBy(F.col("cumulative_cost_usd").desc(), F.col("service"))
    ranked = sums.withColumn("cost_rank", F.row_number().over(w).cast("bigint"))
    return ranked.filter(F.col("cost_rank") <= top_n) if top_n else ranked


def tickets_range(tickets: DataFrame, start: str, end: str, org_id=None) -> DataFrame:
    """V3: daily ticket metrics in [start, end], newest first within an org."""
    return (_in_range(point_filter(tickets, org_id=org_id), "ticket_date", start, end)
            .select("org_id", "ticket_date", "total_tickets", "critical_tickets_count",
                    "avg_csat", "sla_breach_rate"))


def revenue_lines(revenue: DataFrame, org_id=None) -> DataFrame:
    """V4 + O3: monthly revenue lines, newest month first within an org; ``line_no`` is the
    place (rows of different orgs need no common order, so nothing is sorted globally)."""
    newest = Window.partitionBy("org_id").orderBy(F.col("month").desc())
    return (point_filter(revenue, org_id=org_id)
            .select("org_id", "month", "total_subtotal_usd", "total_credits_usd",
                    "total_taxes_usd", "net_revenue_usd",
                    F.row_number().over(newest).cast("bigint").alias("line_no")))


def genai_days(usage: DataFrame, org_id=None, service: str = "genai") -> DataFrame:
    """V5: tokens and cost per day for the GenAI service."""
    return (point_filter(usage, org_id=org_id, service=service)
            .select("org_id", "service", "usage_date", "total_genai_tokens", "total_cost_usd"))


def profile_view(profile: DataFrame, org_id=None, scale: int = 2) -> DataFrame:
    """V6 + F12: profile with the cost map rounded for display."""
    return (point_filter(profile, org_id=org_id)
            .withColumn("service_accumulated_costs",
                        round_map_values("service_accumulated_costs", scale)))
