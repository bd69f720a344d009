"""Connected components by alternating large-star and small-star rounds.

Each round is two joins on the edge list and is written to the shared scratch folder, so
lineage stays short and a lost executor costs one round.  No adjacency list is collected:
a node's smallest neighbour is a partial aggregate, joined back to the edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloudmarts.session import scratch_path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared scratch folder and read it back (a lineage cut)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (both.join(low, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    lower = down.join(low, "u").where(F.col("v") != F.col("m")).select(
        F.col("v").alias("u"), F.col("m").alias("v"))
    return lower.union(low.select("u", F.col("m").alias("v"))).distinct()


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).head()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(u, v) long links -> (node, root): ``root`` is the smallest node reachable.

    Self-links, repeated links and links with a null end are ignored; nodes without a link
    to another node are not returned; no links give an empty result.
    """
    links = (edges.select(F.col("u").cast("long").alias("u"), F.col("v").cast("long").alias("v"))
             .where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v"))))
    now = stage(links.distinct(), "links")
    seen = _digest(now)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        now = stage(_small_star(_large_star(now)), "links")
        found = _digest(now)
        if found == seen:
            break
        seen = found
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select("v", "v")).distinct()
