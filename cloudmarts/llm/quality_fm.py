"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

score = sigmoid(b + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]):
all pairwise interactions of a text's features in time linear in their number.

Fitting uses a bounded sample of labelled rows (``sample_rows``, ``sample_features``) in
numpy on the driver; scoring is one Arrow pass over every whole text, no shuffle.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD_BUCKETS = 1 << 15
FACTORS = 8
SAMPLE_ROWS = 8_000          # labelled rows the model is fitted on, at most
SAMPLE_FEATURES = 4_000_000  # non-zero features of those rows, at most
THRESHOLD = 0.3

_BINS = 8  # one-hot cells of a structure statistic
#: (name, first edge, last edge) of the structure statistics' cells, evenly spaced.
_STATS = (
    ("log_bytes", 2.0, 12.0), ("log_words", 0.0, 10.0), ("word_bytes", 2.0, 14.0),
    ("upper", 0.0, 0.5), ("digit", 0.0, 0.2), ("blank", 0.0, 0.4), ("non_ascii", 0.0, 0.3),
    ("stop", 0.0, 0.1), ("pipe", 0.0, 0.1), ("bang", 0.0, 0.1), ("symbol", 0.0, 0.2),
    ("punct", 0.0, 0.3), ("distinct_words", 0.0, 1.0), ("top_word", 0.0, 0.3),
    ("distinct_lines", 0.0, 1.0), ("line_words", 0.0, 60.0), ("distinct_pairs", 0.0, 1.0),
    ("doubled", 0.0, 0.5),
)
_META_BINS = 16  # log2 cells of a metadata number; the last one is "missing"


def _cls(chars: bytes) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars)] = 1.0
    return out


_CLASSES = np.stack([
    _cls(bytes(range(65, 91))), _cls(b"0123456789"), _cls(b" \t\n\r\x0b\x0c"),
    _cls(bytes(range(128, 256))), _cls(b"."), _cls(b"|"), _cls(b"!"), _cls(b"#$%&*@^~=<>{}[]\\_"),
    _cls(bytes(c for c in range(33, 127) if not chr(c).isalnum())),
], axis=1)


def structure(data: bytes, words: list[bytes], counts: Counter) -> np.ndarray:
    """The statistics of _STATS for one text, words in lower case (all 0 for an empty one)."""
    n, k = len(data), len(words)
    if not n:
        return np.zeros(len(_STATS))
    shares = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256) @ _CLASSES / n
    lines = [x for x in data.split(b"\n") if x.strip()]
    pairs = len(set(zip(words, words[1:], strict=False))) / max(1, k - 1)
    return np.array([
        np.log(n), np.log1p(k), sum(map(len, words)) / max(1, k), shares[0], shares[1],
        shares[2], shares[3], shares[4], shares[5], shares[6], shares[7], shares[8],
        len(counts) / max(1, k), max(counts.values(), default=0) / max(1, k),
        len(set(lines)) / max(1, len(lines)), k / max(1, len(lines)), pairs,
        sum(map(eq, words, words[1:])) / max(1, k - 1)])


def n_features(n_meta: int) -> int:
    return WORD_BUCKETS + len(_STATS) * (_BINS + 1) + n_meta * _META_BINS


def features(text: str | None, meta: tuple = ()) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct indices, values) of one whole text (null: empty)."""
    data = (text or "").encode("utf-8")
    words = data.lower().split()
    counts = Counter(words)
    bag: dict[int, float] = {}
    for word, n in counts.items():
        i = zlib.crc32(word) % WORD_BUCKETS
        bag[i] = bag.get(i, 0.0) + n
    index = np.fromiter(bag.keys(), dtype=np.int32, count=len(bag))
    value = np.log1p(np.fromiter(bag.values(), dtype=np.float64, count=len(bag)))
    value /= max(1e-9, np.sqrt((value ** 2).sum()))
    stats = structure(data, words, counts)
    cells = [max(0, min(_BINS - 1, int((s - lo) / (hi - lo) * _BINS)))
             for s, (_, lo, hi) in zip(stats, _STATS, strict=True)]
    base = WORD_BUCKETS
    hot = [base + j * (_BINS + 1) + c for j, c in enumerate(cells)]
    dense = [base + j * (_BINS + 1) + _BINS for j in range(len(_STATS))]
    scaled = [min(2.0, max(0.0, (s - lo) / (hi - lo))) for s, (_, lo, hi) in zip(stats, _STATS, strict=True)]
    base += len(_STATS) * (_BINS + 1)
    known = [base + j * _META_BINS + (_META_BINS - 1 if m is None or m != m else
                                      min(_META_BINS - 2, int(max(0.0, float(m))).bit_length()))
             for j, m in enumerate(meta)]
    extra = 1.0 / np.sqrt(len(_STATS))
    index = np.concatenate([index, np.array(hot + dense + known, dtype=np.int32)])
    value = np.concatenate([value, np.full(len(hot), extra), extra * np.array(scaled),
                            np.full(len(known), extra)])
    order = np.argsort(index)
    return index[order], value[order].astype(np.float32)


@dataclass
class FactorisationMachine:
    bias: float
    weight: np.ndarray   # [features]
    factor: np.ndarray   # [features, FACTORS]

    def logits(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Of rows laid end to end; row r starts at starts[r] (no row is empty)."""
        xv = self.factor[index] * value[:, None]
        total = np.add.reduceat(xv, starts, axis=0)
        squares = np.add.reduceat((xv * xv).sum(axis=1), starts)
        linear = np.add.reduceat(self.weight[index] * value, starts)
        return self.bias + linear + 0.5 * ((total * total).sum(axis=1) - squares)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int,
        epochs: int = 12, rate: float = 0.08, l2: float = 2e-5, seed: int = 7) -> FactorisationMachine:
    """AdaGrad on the logistic loss.  Without rows: a constant 0.5."""
    rng = np.random.default_rng(seed)
    model = FactorisationMachine(0.0, np.zeros(size, np.float32),
                                 (rng.standard_normal((size, FACTORS)) * 0.05).astype(np.float32))
    if not rows:
        model.factor[:] = 0
        return model
    mean = float(np.clip(labels.mean(), 0.02, 0.98))
    model.bias = float(np.log(mean / (1 - mean)))
    sum_w, sum_v, sum_b = np.full(size, 1e-3, np.float32), np.full((size, FACTORS), 1e-3, np.float32), 1e-3
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 64):
            batch = order[at:at + 64]
            index = np.concatenate([rows[r][0] for r in batch])
            value = np.concatenate([rows[r][1] for r in batch])
            lengths = np.array([len(rows[r][0]) for r in batch])
            starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
            xv = model.factor[index] * value[:, None]
            total = np.add.reduceat(xv, starts, axis=0)
            logit = (model.bias + np.add.reduceat(model.weight[index] * value, starts)
                     + 0.5 * ((total * total).sum(1) - np.add.reduceat((xv * xv).sum(1), starts)))
            error = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[batch]) / len(batch)).astype(np.float32)
            each = np.repeat(error, lengths) * value
            used, place = np.unique(index, return_inverse=True)
            grad_w = np.bincount(place, each, len(used)) + l2 * model.weight[used]
            pull = each[:, None] * (np.repeat(total, lengths, axis=0) - xv)
            grad_v = np.stack([np.bincount(place, pull[:, f], len(used)) for f in range(FACTORS)],
                              axis=1) + l2 * model.factor[used]
            sum_w[used] += grad_w ** 2
            sum_v[used] += grad_v ** 2
            model.weight[used] -= rate * grad_w / np.sqrt(sum_w[used])
            model.factor[used] -= rate * grad_v / np.sqrt(sum_v[used])
            g = float(error.sum())
            sum_b += g * g
            model.bias -= rate * g / sum_b ** 0.5
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from: crc32 of the id as text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, metadata: tuple[str, ...] = (),
          sample_rows: int = SAMPLE_ROWS, sample_features: int = SAMPLE_FEATURES) -> FactorisationMachine:
    """Fit on labelled rows that are not held out: the ``sample_rows`` smallest by a hash of
    the id, then as many of them as hold ``sample_features`` non-zero features together.

    An id labelled more than once gets the mean label; null labels and ids are no labels.
    """
    n_meta = len(metadata)
    known = (labels.select("doc_id", F.col("quality").cast("double").alias("quality"))
             .where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
             .groupBy("doc_id").agg(F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.avg("quality"))).alias("quality"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    taken = (docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"),
                         F.array(*[F.col(f"`{c}`").cast("double") for c in metadata])
                         .cast("array<double>").alias("meta"))
             .join(F.broadcast(known), "doc_id"))  # at most sample_rows small rows

    def featurise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [features(t, tuple(m)) for t, m in zip(batch["text"], batch["meta"], strict=True)]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "quality": batch["quality"],
                "n": [len(i) for i, _ in found],
                "index": [i.tobytes() for i, _ in found], "value": [v.tobytes() for _, v in found]})

    rows = taken.mapInPandas(featurise, "doc_id long, quality double, n long, index binary, value binary")
    order = [F.xxhash64("doc_id"), F.col("doc_id"), F.xxhash64("index")]
    rows = rows.orderBy(*order).limit(sample_rows)
    so_far = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    sample = (rows.withColumn("so_far", F.sum("n").over(so_far))
              .where(F.col("so_far") <= sample_features).select("quality", "index", "value").collect())
    return fit([(np.frombuffer(r["index"], np.int32), np.frombuffer(r["value"], np.float32)) for r in sample],
               np.array([r["quality"] for r in sample], dtype=np.float32), n_features(n_meta))


def score(spark: SparkSession, model: FactorisationMachine, text: Column, *metadata: Column) -> Column:
    """The probability of label 1 for every whole text; null texts score like empty ones, null
    metadata has a feature of its own."""
    shared = spark.sparkContext.broadcast((model.bias, model.weight, model.factor))

    @F.arrow_udf("double")
    def probability(texts: pa.Array, *meta: pa.Array) -> pa.Array:
        machine = FactorisationMachine(*shared.value)
        out = np.empty(len(texts))
        for r, text in enumerate(texts):
            index, value = features(text.as_py(), tuple(m[r].as_py() for m in meta))
            out[r] = machine.logits(index, value, np.zeros(1, dtype=np.int64))[0]
        return pa.array(1 / (1 + np.exp(-np.clip(out, -30, 30))), pa.float64())

    return probability(text.cast("string"), *[m.cast("double") for m in metadata])


def quality_scores(docs: DataFrame, labels: DataFrame, metadata: tuple[str, ...] = ("n_chars",),
                   threshold: float = THRESHOLD) -> DataFrame:
    """One row per document row: doc_id, held_out, score, predicted.  Repeated rows stay
    repeated and score alike; without usable labels every score is 0.5; an empty table gives
    an empty result."""
    model = train(docs, labels, metadata)
    return docs.select("doc_id", held_out().alias("held_out"), _score(docs, model, metadata).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, metadata: tuple[str, ...] = ("n_chars",),
              threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, columns unchanged."""
    return docs.where(_score(docs, train(docs, labels, metadata), metadata) >= threshold)


def _score(docs: DataFrame, model: FactorisationMachine, metadata: tuple[str, ...]) -> Column:
    return score(docs.sparkSession, model, F.col("text"), *[F.col(f"`{c}`") for c in metadata])
