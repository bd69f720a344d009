"""Landing readers: CSV masters and JSON-lines usage events.

Schemas are always declared, never inferred.  CSV parsing is PERMISSIVE with a
corrupt-record column, so a bad cell or a short/long row is captured instead of
silently becoming NULLs; callers route ``_corrupt`` rows to a quarantine.
"""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.ingest import dedup_latest, stamp
from ..schemas import LANDING, MULTILINE_MASTERS, USAGE_EVENT
from ..sinks import staged

CORRUPT = "_corrupt"


def with_corrupt(schema: StructType, corrupt_col: str = CORRUPT) -> StructType:
    """The schema plus the column that keeps a malformed record's raw text."""
    return StructType(list(schema.fields) + [StructField(corrupt_col, StringType(), True)])


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType,
             corrupt_col: str = CORRUPT, multi_line: bool = False) -> DataFrame:
    """Header CSV (RFC 4180 quoting) with a declared schema; malformed rows
    keep their raw text in ``corrupt_col`` (NULL for good rows).  ``multi_line``
    allows quoted line breaks at the cost of one task per file."""
    return (spark.read
            .option("header", "true")
            # validate each file's header against the schema: a reordered or renamed
            # column fails the read instead of loading into the wrong field
            .option("enforceSchema", "false")
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", corrupt_col)
            .option("quote", '"').option("escape", '"')
            .option("multiLine", str(multi_line).lower())
            .schema(with_corrupt(schema, corrupt_col))
            .csv(path))


def split_corrupt(df: DataFrame, corrupt_col: str = CORRUPT) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, corrupt rows).

    Spark refuses a query over raw CSV/JSON whose only referenced column is the
    corrupt-record column (e.g. a bare ``count()`` of the bad side); write the bad
    rows (all columns) to a quarantine table and count there.
    """
    bad = F.col(corrupt_col).isNotNull()
    return df.filter(~bad).drop(corrupt_col), df.filter(bad)


def ingest_master(spark: SparkSession, path: str | list[str], dataset: str,
                  order_by: Sequence[Column] | None = None, deduplicate: bool = True,
                  seen: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """Bronze ingest of one landing master (a folder, or a list of files): read, stamp,
    deterministic dedup.

    Returns (bronze rows, corrupt rows).  ``source_file`` is the file each row came from;
    ``ingest_ts`` is one value per call, the same on both sides.  Both come from one staged
    parse, unless ``seen`` is given: then the dedup sorts rows straight from the file splits,
    which hold fewer rows than those of a staged copy, ``seen`` observes ``n_corrupt`` while the
    bronze rows are written, and the corrupt rows are to be asked of ``corrupt_rows``.
    """
    schema, keys, _part = LANDING[dataset]
    # a literal, so that it is added to the rows after their shuffle
    now = F.timestamp_micros(F.lit(time.time_ns() // 1000))
    raw = stamp(read_csv(spark, path, schema, multi_line=dataset in MULTILINE_MASTERS)).withColumn("ingest_ts", now)
    if seen is None or not deduplicate:
        raw = staged(raw, f"parsed-{dataset}")
    bad = split_corrupt(raw)[1]
    if not deduplicate:
        return split_corrupt(raw)
    if seen is not None:
        # all columns are in the dedup's order, so every cell is checked whatever is selected of it
        raw = raw.observe(seen, F.count_if(F.col(CORRUPT).isNotNull()).alias("n_corrupt"))
    good = split_corrupt(raw)[0].withColumn("ingest_ts", now)
    return dedup_latest(good, keys, order_by, exclude_from_tiebreak=["ingest_ts"]), bad


def corrupt_rows(bad: DataFrame, seen: Observation) -> DataFrame:
    """The corrupt rows of ``ingest_master``, asked for after its bronze rows were written: if
    those files held none, an empty frame in their place, so that they are not scanned again.
    They are staged whole: a scan of fewer columns would check fewer cells."""
    if int(seen.get.get("n_corrupt") or 0):
        return staged(bad, "corrupt-rows")
    return bad.sparkSession.createDataFrame([], bad.schema)


def parse_event_time(df: DataFrame, src: str = "timestamp",
                     out: str = "timestamp_parsed") -> DataFrame:
    """Text event time to TIMESTAMP; malformed text gives NULL, never an error."""
    return df.withColumn(out, F.try_to_timestamp(F.col(src)))


def read_usage_json(spark: SparkSession, path: str, schema: StructType = USAGE_EVENT) -> DataFrame:
    """S8 (batch form): JSON-lines events with the declared schema, parsed and stamped; a
    malformed line keeps its text in ``_corrupt`` (see ``split_corrupt``)."""
    raw = (spark.read.schema(with_corrupt(schema)).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    return parse_event_time(stamp(raw))
