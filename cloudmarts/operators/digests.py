"""Content digests of serving tables, kept up to date by every load.

The digest of a partition (a month's bucket) is its row count and the exact sum of its rows'
64-bit hashes: it does not depend on order or files, and any changed, lost or repeated row moves
it.  Digests add up, so a month's digest is the sum over its buckets and the table's the sum over
its months: two tables are compared from the top down, reading only what differs.

Every load appends one version with the digests of the partitions it touched, next to the table
(``<path>_digests/_version=n``); the newest version of a partition holds.  A check reads the data
of the partitions in question only, and names those that differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sinks import partition_values, path_exists, read_table, staged, write_table
from .serving import (
    BUCKET, DEFAULT_BUCKETS, LAYOUT_TYPES, PERIOD, bucket_of, open_serving, row_hash,
    touched_predicate, upsert_table,
)

_SUM = "decimal(38,0)"


def digest_path(path: str) -> str:
    return f"{path.rstrip('/')}_digests"


def partition_digests(table: DataFrame) -> DataFrame:
    """_period, _bucket, n_rows, digest of an opened serving table (without months: a null one)."""
    period = F.col(PERIOD) if PERIOD in table.columns else F.lit(None).cast("date").alias(PERIOD)
    rows = table.select(period, BUCKET, row_hash(table).alias("h"))
    return rows.groupBy(PERIOD, BUCKET).agg(F.count("*").alias("n_rows"), F.sum("h").cast(_SUM).alias("digest"))


def _touched(rows: DataFrame, period_col: str | None, partition_key: Sequence[str], n_buckets: int) -> list[tuple]:
    """The partitions of the rows: at most months x buckets small values."""
    columns = [F.trunc(F.col(period_col).cast("date"), "month").alias(PERIOD)] if period_col else []
    return [tuple(r) for r in rows.select(*columns, bucket_of(partition_key, n_buckets).alias(BUCKET)).distinct().collect()]


def _part_of(table: DataFrame, touched: Sequence[tuple]) -> DataFrame:
    layout = [c for c in (PERIOD, BUCKET) if c in table.columns]
    return table.where(touched_predicate(layout, list(touched)))


def record_digests(spark: SparkSession, path: str, touched: Sequence[tuple] | None = None) -> int:
    """Append a version with the digests of the touched partitions (all of them if not given);
    returns its number."""
    table = open_serving(spark, path)
    log = digest_path(path)
    version = 1 + max((int(v) for v in partition_values(spark, log, "_version")), default=-1) if path_exists(spark, log) else 0
    part = table if touched is None else _part_of(table, touched)
    write_table(partition_digests(part).coalesce(1), f"{log}/_version={version}")
    return version


def upsert_digested(spark: SparkSession, path: str, incoming: DataFrame, keys: Sequence[str],
                    partition_key: Sequence[str] = ("org_id",), n_buckets: int = DEFAULT_BUCKETS,
                    period_col: str | None = None, **options) -> tuple[int, list[tuple]]:
    """``serving.upsert_table``, then the digests of the partitions it touched; returns rows
    written and those partitions.  After a kill between the two, running the load again repairs
    the digests, as it touches the same partitions."""
    incoming = staged(incoming, "digested-incoming")
    n = upsert_table(spark, path, incoming, keys, partition_key, n_buckets, period_col=period_col, **options)
    touched = _touched(incoming, period_col, partition_key, n_buckets)
    if touched:
        record_digests(spark, path, touched)
    return n, touched


def stored_digests(spark: SparkSession, path: str) -> DataFrame:
    """The newest digest of every partition."""
    log = read_table(spark, digest_path(path), types={**LAYOUT_TYPES})
    newest = Window.partitionBy(PERIOD, BUCKET).orderBy(F.col("_version").desc())
    return log.withColumn("_nth", F.row_number().over(newest)).where("_nth = 1").drop("_nth", "_version")


def month_digests(digests: DataFrame) -> DataFrame:
    """One level up: _period, n_rows, digest."""
    return digests.groupBy(PERIOD).agg(F.sum("n_rows").alias("n_rows"), F.sum("digest").cast(_SUM).alias("digest"))


def table_digest(digests: DataFrame) -> tuple[int, int | None]:
    """The root: rows and digest of the whole table."""
    row = digests.agg(F.sum("n_rows").alias("n"), F.sum("digest").cast(_SUM).alias("d")).head()
    return int(row["n"] or 0), None if row["d"] is None else int(row["d"])


def _unlike(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    left = a.select(*keys, F.col("n_rows").alias("rows_a"), F.col("digest").alias("digest_a"))
    right = b.select(*[F.col(k).alias(f"{k}_b") for k in keys], F.col("n_rows").alias("rows_b"), F.col("digest").alias("digest_b"))
    same_key = F.lit(True)
    for k in keys:
        same_key = same_key & F.col(k).eqNullSafe(F.col(f"{k}_b"))
    both = left.join(right, same_key, "full_outer")
    return both.where(~(F.col("rows_a").eqNullSafe(F.col("rows_b")) & F.col("digest_a").eqNullSafe(F.col("digest_b")))).select(
        *[F.coalesce(F.col(k), F.col(f"{k}_b")).alias(k) for k in keys], "rows_a", "rows_b")


def changed_partitions(spark: SparkSession, path: str, touched: Sequence[tuple] | None = None) -> DataFrame:
    """Partitions whose rows differ from their stored digest: _period, _bucket, rows_a (stored),
    rows_b (found).  With ``touched`` only those partitions' data is read."""
    stored, table = stored_digests(spark, path), open_serving(spark, path)
    if touched is not None:
        table = _part_of(table, touched)
        wanted = [(None, *t) if len(t) == 1 else t for t in touched]
        keys = spark.createDataFrame(wanted, f"p date, {BUCKET}_w long")
        stored = stored.join(F.broadcast(keys), F.col(PERIOD).eqNullSafe(F.col("p")) & (F.col(BUCKET) == F.col(f"{BUCKET}_w")),
                             "left_semi")
    return _unlike(stored, partition_digests(table), [PERIOD, BUCKET])


def compare_tables(spark: SparkSession, path_a: str, path_b: str) -> DataFrame:
    """Partitions that differ between two tables of the same layout, from stored digests alone:
    first the roots, then the months, then the buckets of months that differ."""
    a, b = stored_digests(spark, path_a), stored_digests(spark, path_b)
    if table_digest(a) == table_digest(b):
        return _unlike(a.limit(0), b.limit(0), [PERIOD, BUCKET])
    months = F.broadcast(_unlike(month_digests(a), month_digests(b), [PERIOD]).select(F.col(PERIOD).alias("m")))
    a, b = (d.join(months, F.col(PERIOD).eqNullSafe(F.col("m")), "left_semi") for d in (a, b))
    return _unlike(a, b, [PERIOD, BUCKET])


def rerun_check(spark: SparkSession, path: str, incoming: DataFrame, keys: Sequence[str], n_buckets: int = DEFAULT_BUCKETS,
                period_col: str | None = None) -> DataFrame:
    """Load ``incoming`` again and name the touched partitions whose content changed; an empty
    result says the load is idempotent.  Only touched partitions are read."""
    before = staged(stored_digests(spark, path), "digests-before")
    _n, touched = upsert_digested(spark, path, incoming, keys, n_buckets=n_buckets, period_col=period_col)
    if not touched:
        return _unlike(before.limit(0), before.limit(0), [PERIOD, BUCKET])
    return _unlike(before, stored_digests(spark, path), [PERIOD, BUCKET])
