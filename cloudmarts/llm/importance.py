"""Target-distribution importance resampling over hashed word n-grams.

A document's weight is the mean gain of its features (runs of one or two words, hashed to a
bucket): the log ratio of how often the target and the corpus use the bucket.  Both are counted
over all their texts; a task adds its rows up in one array of buckets, so the corpus count is an
exchange of at most ``buckets`` numbers a task, whatever the words.  A Gumbel draw seeded by the
document's id is added to each weight, and the highest scores among the eligible documents are a
sample without replacement in proportion to their weights' exponentials.

The cut is found without a sort: quickselect over the narrow table of scores.  Each round picks
random pivot keys from the rows still open, counts exactly how many eligible rows lie below, at
and above every pivot, and keeps the interval that holds the k-th key.  Keys are (score, doc_id,
row), all different, so the cut is exact under ties and repeated rows.  Only the winners are then
ranged, sorted and ranked.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cloudmarts.llm.components import stage
from cloudmarts.llm.shards import range_parts

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7
PIVOTS = 32
_ROWS = 64  # texts a task holds the words of
# on UTF-8 bytes, where everything beyond ASCII is made of bytes from 0x80 on
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of anything beyond ASCII, A-Z in lower case."""
    return _WORD.findall((text or "").encode().translate(_LOWER))


def feature_buckets(words: Sequence[bytes], buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of every word and of every two neighbouring words joined by a blank."""
    crc = zlib.crc32
    ones = list(map(crc, words))
    # the checksum of a pair goes on from its first word's
    twos = [crc(b" " + after, c) for c, after in zip(ones, words[1:])]
    return np.array(ones + twos, np.int64) % buckets


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            yield part, part.column(column).to_pylist()


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket: one pass, at most ``buckets`` rows
    from a task, ``buckets`` numbers to the driver."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, texts in _texts(batches, 0):
            for text in texts:
                total += np.bincount(feature_buckets(words_of(text), buckets), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())],
                                         names=["bucket", "n"])

    rows = (docs.select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(buckets, np.int64)
    for r in rows:
        counts[r["bucket"]] = r["n"]
    return counts


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + buckets) / ((s + 1)(T + buckets)))) of each bucket, in doubles."""
    n = len(corpus)
    whole_s, whole_t = float(int(corpus.sum()) + n), float(int(target.sum()) + n)
    return np.array([math.floor(1000 * math.log((t + 1.0) * whole_s / ((s + 1.0) * whole_t)))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def gumbel_milli(doc_id: int | None, seed: int = SEED) -> int:
    """floor(-1000 ln(-ln u)), u drawn from the hash of seed and id (null id: empty text)."""
    key = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gains: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every row."""
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _texts(batches, 1):
            ids = batch.column(0).to_pylist()
            n_words, n_features, weights = [], [], []
            for text in texts:
                words = words_of(text)
                features = feature_buckets(words, len(gains))
                n_words.append(len(words))
                n_features.append(len(features))
                weights.append(int(gains[features].sum()) // len(features) if len(features) else 0)
            scores = [w + gumbel_milli(i, seed) for w, i in zip(weights, ids, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in (
                n_words, n_features, weights, scores))], names=["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        score, "doc_id long, n_words long, n_features long, weight long, score long")


def kth_key(rows: DataFrame, keys: Sequence[str], k: int, pivots: int = PIVOTS, seed: int = SEED) -> tuple | None:
    """The k-th smallest of the ``keys`` (non-null numbers, together different in every row), by
    quickselect: a round reads the open rows' keys twice, for ``pivots`` random ones and for the
    rows below and at each.  About log(rows) / log(pivots) rounds; the driver sees pivots and
    counts only.  None where there are fewer rows than k, or k < 1."""
    key = F.struct(*[F.col(c).cast("long").alias(c) for c in keys])
    rows = rows.select(key.alias("key"))
    if k < 1:
        return None
    low = high = None  # the k-th key lies strictly between these
    before = 0         # rows at or below low

    def lit(found: tuple):
        return F.struct(*[F.lit(v).cast("long").alias(c) for v, c in zip(found, keys, strict=True)])

    turn = 0
    while True:
        turn += 1
        open_rows = rows
        if low is not None:
            open_rows = open_rows.where(F.col("key") > lit(low))
        if high is not None:
            open_rows = open_rows.where(F.col("key") < lit(high))
        drawn = open_rows.orderBy(F.xxhash64("key", F.lit(seed), F.lit(turn)), "key").limit(pivots).collect()
        tried = sorted(tuple(r["key"]) for r in drawn)
        if not tried:
            return None
        counts = open_rows.agg(*[
            F.count_if(part).alias(f"{name}{i}") for i, pivot in enumerate(tried)
            for name, part in (("below", F.col("key") < lit(pivot)), ("at", F.col("key") == lit(pivot)))]).head()
        start = before
        for i, pivot in enumerate(tried):
            below, at = start + counts[f"below{i}"], counts[f"at{i}"]
            if below < k <= below + at:
                return pivot
            if below + at < k:
                low, before = pivot, below + at
            else:
                high = pivot
                break


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """One row per input row: doc_id, n_words, n_features, weight, score, rank; rank 1, 2, ...
    over the floor(percent N / 100) highest scores of the N rows with ``least_words`` words,
    null for the others; ties go to the smaller doc_id (null first), then to either copy.

    Null texts have no word, weight 0, and are never drawn; repeated rows are drawn each for
    themselves; an empty target leaves the corpus' own frequencies to decide; an empty table
    gives an empty result; other columns are not read.  Ids must be whole numbers.
    """
    gains = bucket_gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    scored = stage(weigh(docs, gains, seed).withColumn("row", F.monotonically_increasing_id()), "scored")
    eligible = scored.where(F.col("n_words") >= least_words)
    k = eligible.count() * percent // 100
    keyed = {"k_score": -F.col("score"), "k_null": F.col("doc_id").isNotNull().cast("long"),
             "k_id": F.coalesce("doc_id", F.lit(0)), "k_row": F.col("row")}
    cut = kth_key(eligible.withColumns(keyed).select(*keyed), list(keyed), k, seed=seed)
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    unranked = F.lit(None).cast("long").alias("rank")
    if cut is None:
        return scored.select(*columns, unranked)
    wins = (F.col("n_words") >= least_words) & (
        F.struct(*keyed.values()) <= F.struct(*[F.lit(v).cast("long") for v in cut]))
    winners = scored.where(wins).withColumns(keyed)
    parts = range_parts(winners, *keyed)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range partition
    starts = parts.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = parts.withColumn("nth", F.row_number().over(Window.partitionBy("part").orderBy(*keyed))).join(
        F.broadcast(starts), "part")
    return ranked.select(*columns, (F.col("before") + F.col("nth")).cast("long").alias("rank")).unionByName(
        scored.where(~wins).select(*columns, unranked))
