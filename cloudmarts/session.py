"""Session construction and shared-folder helpers.

Library functions never build their own session; they take the caller's.
``build_session`` is for scripts and tests.  Scratch output (staging tables,
round-trip files, stream checkpoints) always goes under the folder the cluster
names in ``spark.checkpoint.dir``; a local folder is only chosen when that
setting is unset and the master is local (tests).
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "cloudmarts",
                  advisory_partition_bytes: int = 128 * 1024 * 1024,
                  max_partition_bytes: int = 256 * 1024 * 1024) -> SparkSession:
    """Session with the settings the library assumes: UTC, AQE with skew-join
    splitting, ANSI on, no UI.

    ``shuffle_partitions`` unset leaves Spark's setting alone; on a cluster set it high
    (e.g. 4-8x the cores) and let AQE coalesce toward ``advisory_partition_bytes``;
    ``max_partition_bytes`` sizes scan splits.  Streaming state lives in RocksDB, so a first
    run over many files is not held in executor heap.  AQE also splits skewed shuffle partitions in joins and in REBALANCE
    writes, so a key holding a third of the data is spread over several tasks.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = (
        builder
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(advisory_partition_bytes))
        .config("spark.sql.files.maxPartitionBytes", str(max_partition_bytes))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and scratch tables.

    Read from the session; set only when unset on a local master.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir().rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):  # local-cluster is a cluster
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster needs a shared folder for checkpoints")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="cloudmarts-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/scratch/{name}-{uuid.uuid4().hex[:12]}"


#: For long flows: the shuffle files of a query go when it ends (else they stay until the driver's
#: garbage collector finds them, those of all steps at once), and tables are a quarter smaller.
LITTLE_DISK = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
               "spark.sql.parquet.compression.codec": "zstd"}


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """The session with these settings; the former ones are put back at the end."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def run_concurrently(spark: SparkSession, tasks: dict, workers: int = 4) -> dict:
    """Run independent steps (each submitting its own Spark jobs) from a few driver
    threads; Spark schedules their jobs side by side.  Each thread keeps the caller's
    job group.  Returns name -> result; the first failure is raised."""
    from concurrent.futures import ThreadPoolExecutor

    sc = spark.sparkContext
    group = sc.getLocalProperty("spark.jobGroup.id")

    def call(fn):
        if group:
            sc.setJobGroup(group, group)
        return fn()

    with ThreadPoolExecutor(max_workers=max(1, min(workers, len(tasks)))) as pool:
        futures = {name: pool.submit(call, fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}
