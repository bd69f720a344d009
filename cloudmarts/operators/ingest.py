"""Ingest metadata and deterministic deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType


def stamp(df: DataFrame, source: str | None = None) -> DataFrame:
    """``ingest_ts`` (one value per query) and ``source_file``.

    With ``source`` given the literal is used; otherwise the reader's own file
    path (``_metadata.file_path``), so ``df`` must come straight from a file scan.
    """
    src = F.lit(source) if source is not None else F.col("_metadata.file_path")
    return df.withColumns({"ingest_ts": F.current_timestamp(), "source_file": src})


def _orderable(dtype) -> bool:
    if isinstance(dtype, MapType):
        return False
    if isinstance(dtype, StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return True


def total_order(df: DataFrame, keys: Sequence[str],
                order_by: Sequence[Column] | None = None,
                exclude: Sequence[str] = ()) -> list[Column]:
    """``order_by`` followed by every other orderable column, ascending.

    The tail makes the order total, so the row kept per key never depends on
    partitioning or task timing.
    """
    skip = set(keys) | set(exclude)
    tail = [F.col(f"`{f.name}`").asc_nulls_first() for f in df.schema.fields
            if f.name not in skip and _orderable(f.dataType)]
    return list(order_by or []) + tail


def dedup_latest(df: DataFrame, keys: Sequence[str],
                 order_by: Sequence[Column] | None = None,
                 exclude_from_tiebreak: Sequence[str] = ()) -> DataFrame:
    """Keep exactly one row per key, the first in ``order_by``.

    ``row_number() = 1`` is planned with a partial WindowGroupLimit before the
    shuffle, so every map task sends at most one row per key: a key that holds a
    third of the input costs no more shuffle than any other.  NULL keys compare
    equal, as in ``dropDuplicates``.
    """
    order = total_order(df, keys, order_by, exclude_from_tiebreak)
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return (df.withColumn("__rn", F.row_number().over(w))
              .filter(F.col("__rn") == 1)
              .drop("__rn"))
