"""Dimension joins with a size-checked broadcast.

A side is broadcast only after its size has been measured against a bound;
beyond the bound the join stays a shuffle join, where AQE's skew-join split
handles hot keys.  Nothing is broadcast on trust.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, ByteType, DateType, DoubleType, FloatType, IntegerType, LongType,
    ShortType, StringType, TimestampNTZType, TimestampType,
)

from ..session import checkpoint_root

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024

_FIXED = {BooleanType: 1, ByteType: 1, ShortType: 2, IntegerType: 4, DateType: 4,
          FloatType: 4, LongType: 8, DoubleType: 8, TimestampType: 8, TimestampNTZType: 8}


def row_bytes(df: DataFrame) -> int:
    """Fixed part of one row's in-memory width (string and other variable-width
    columns are measured separately by ``measured_bytes``)."""
    total = 16
    for f in df.schema.fields:
        t = type(f.dataType)
        total += _FIXED.get(t, 8 if t is StringType else 64)
    return total


def measured_bytes(df: DataFrame) -> int:
    """Rows x fixed width plus the actual UTF-8 bytes of every string column, in one
    aggregate job."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    aggs = [F.count(F.lit(1)).alias("n")]
    if strings:
        text = sum((F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) for c in strings),
                   F.lit(0))
        aggs.append(F.sum(text.cast("bigint")).alias("text"))
    r = df.agg(*aggs).first()
    return int(r["n"]) * row_bytes(df) + int((r["text"] if strings else 0) or 0)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage (reliable checkpoint in the shared folder)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def checked_broadcast(small: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES,
                      compute_once: bool = False) -> DataFrame:
    """Return ``broadcast(small)`` if its measured size (rows x fixed width + actual
    string bytes) is within ``max_bytes``.

    ``compute_once`` first materialises ``small`` (use it for an aggregate that
    would otherwise be computed twice: once for the count, once for the join).
    Plain dimension scans are measured by one scan of the projected columns and need
    no copy.
    """
    if compute_once:
        small = materialize(small)
    if measured_bytes(small) <= max_bytes:
        return F.broadcast(small)
    return small


ORG_COLUMNS = ["org_id", "org_name", "plan_tier", "is_enterprise"]
RESOURCE_COLUMNS = ["resource_id", "state"]


def enrich(events: DataFrame, orgs: DataFrame, resources: DataFrame,
           max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Left joins on the organisation and the resource.

    The dimensions must be unique on their key (deduplicated at ingest), so the
    joins never fan out; orphan events keep NULL attributes.
    """
    o = checked_broadcast(orgs.select(*ORG_COLUMNS), max_broadcast_bytes)
    r = checked_broadcast(resources.select(*RESOURCE_COLUMNS), max_broadcast_bytes)
    return events.join(o, "org_id", "left").join(r, "resource_id", "left")
