"""Table writers (K1, K2, K7).

Row counts are observed during the write (``DataFrame.observe``) instead of a
second ``count()`` that would re-run the whole lineage.  Partitioned overwrites
can be dynamic, so re-running one day rewrites one day.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from .session import scratch_path

DEFAULT_MAX_RECORDS_PER_FILE = 5_000_000


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                mode: str = "overwrite", dynamic: bool = False,
                max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE,
                sort_within: Sequence = ()) -> int:
    """Write parquet and return the number of rows written (observed, no second pass)."""
    return write_observed(df, path, {}, partition_by, mode, dynamic, max_records_per_file,
                          sort_within)["rows"]


def write_observed(df: DataFrame, path: str, metrics: dict,
                   partition_by: Sequence[str] | None = None, mode: str = "overwrite",
                   dynamic: bool = False,
                   max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE,
                   sort_within: Sequence = (), rebalance: bool = False) -> dict:
    """Write parquet; return ``rows`` plus every aggregate in ``metrics`` (name ->
    Column), all computed during the write itself.  ``rebalance`` lays the output out
    with the REBALANCE hint on ``partition_by`` (see ``write_partitioned``)."""
    if rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    obs = Observation()
    aggs = [F.count(F.lit(1)).alias("rows")] + [c.alias(n) for n, c in metrics.items()]
    observed = df.observe(obs, *aggs)
    if sort_within:
        # partition columns first: the writer's own grouping then needs no second sort
        observed = observed.sortWithinPartitions(*(partition_by or []), *sort_within)
    w = observed.write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
    # always explicit: the session's own overwrite mode must not decide what is replaced
    w = w.option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    got = obs.get
    return {"rows": int(got.get("rows", 0)), **{n: got.get(n) for n in metrics}}


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str],
                      dynamic: bool = True,
                      max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE) -> int:
    """Partitioned write laid out by the REBALANCE hint on the partition columns.

    AQE hashes rows on the partition columns, coalesces small output partitions and
    splits skewed ones (``optimizeSkewsInRebalancePartitions``), so a hot partition
    (one service holding a third of the data) is written by several tasks while
    small partitions get one file each.
    """
    return write_observed(df, path, {}, partition_by, dynamic=dynamic,
                          max_records_per_file=max_records_per_file, rebalance=True)["rows"]


def read_table(spark: SparkSession, path: str, schema: StructType | None = None,
               types: Mapping[str, DataType] | None = None) -> DataFrame:
    """Parquet zone table.  ``schema`` pins every column; ``types`` only the named ones
    (T17: partition columns, whose types would else be guessed from the folder names)."""
    if schema is None and types:
        found = spark.read.parquet(path).schema
        schema = StructType([StructField(f.name, types.get(f.name, f.dataType), True) for f in found])
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists, asked of the file system Spark itself would read it from."""
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(sc._jsc.hadoopConfiguration()).exists(where)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of a table's first partition column, from its folder names (no file is read)."""
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in where.getFileSystem(sc._jsc.hadoopConfiguration()).listStatus(where)]
    return [n.split("=", 1)[1] for n in names if n.startswith(f"{column}=")]


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder that no later step reads."""
    sc = spark.sparkContext
    where = sc._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def try_read_table(spark: SparkSession, path: str, schema: StructType | None = None,
                   types: Mapping[str, DataType] | None = None) -> DataFrame | None:
    """The table at ``path``, or None when there is no such path.  Any other failure of the
    read is raised: taking it for a missing table would overwrite what is there."""
    return read_table(spark, path, schema, types) if path_exists(spark, path) else None


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared scratch folder and read back with its schema, for
    results that several later steps use."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staged_meanwhile(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``staged``, for results that no later step reads: the copy is deleted at the end."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        delete_folder(df.sparkSession, path)
