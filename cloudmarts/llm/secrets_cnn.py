"""Secret scans: fixed patterns plus a character convolutional network in numpy.

Base findings follow three fixed patterns.  The network reads every candidate (a run of 16
or more characters of the secret alphabet) with the characters around it, in overlapping
windows if it is long, and adds the candidates that look like the labelled findings.  It is
trained on all windows of all documents, each different one once: those that overlap a base
finding are positives, the others negatives.  A quarter by hash is held back to calibrate the
logits (Platt) and to set one threshold per candidate class: the highest that still recalls
``RECALL`` of the class's positives.  A class with fewer than five held-back positives takes the
threshold of all classes together, at least 0.9.

A label of few windows is learned from whole beside every block; the windows of the others are
dealt by hash to blocks of bounded size.  In each round every block trains one epoch from the
same network, in the tasks, and the networks are averaged.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloudmarts.llm.components import stage

# The base patterns and the fewest characters that count.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_MIN, ACCESS_MIN = 6, 20
KINDS = ("assign", "access", "hex")
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
SHORTEST = 16
BEFORE, INSIDE, AFTER = 20, 48, 8
STRIDE = INSIDE // 2   # between the windows of a long candidate
FEW = 3_000            # windows of a label that is brought to the driver and to every block
BLOCK = 6_000          # windows of a block, about
STEP = 1 / 256         # logits of held-back windows are counted in steps of this
RECALL = 0.98
CLASSES = ("hex", "digits", "mixed", "letters")

_WIDTH = BEFORE + INSIDE + AFTER
_CODES = 98            # printable ASCII, other, padding
_FILTERS, _TAPS = 24, 5

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the fixed patterns, by start, then kind as listed."""
    found: list[Span] = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text)
                  if len(m.group(2)) >= ASSIGN_MIN]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= ACCESS_MIN]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CANDIDATE.finditer(text)]


def clear_parts(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """What the base findings leave of the candidates, where that is long enough for one."""
    out, k = [], 0
    cover: list[list[int]] = []
    for s, e, _ in base:
        if cover and s <= cover[-1][1]:
            cover[-1][1] = max(cover[-1][1], e)
        else:
            cover.append([s, e])
    for a, b in candidates(text):
        while k < len(cover) and cover[k][1] <= a:
            k += 1
        at, j = a, k
        while j < len(cover) and cover[j][0] < b:
            out.append((at, cover[j][0]))
            at, j = cover[j][1], j + 1
        out.append((at, b))
    return [(a, b) for a, b in out if b - a >= SHORTEST]


def slices(start: int, end: int) -> list[tuple[int, int]]:
    """The candidate itself, or overlapping slices of INSIDE characters over all of it."""
    if end - start <= INSIDE:
        return [(start, end)]
    return [(s, s + INSIDE) for s in [*range(start, end - INSIDE, STRIDE), end - INSIDE]]


def window(text: str, start: int, end: int) -> bytes:
    """Character codes around a candidate, one byte each (98 more inside it)."""
    def codes(part: str, inside: int) -> bytes:
        return bytes((ord(c) - 32 if " " <= c <= "~" else 96) + inside for c in part)

    left = codes(text[max(0, start - BEFORE):start], 0)
    body = codes(text[start:min(end, start + INSIDE)], _CODES)
    right = codes(text[end:end + AFTER], 0)
    return (b"\x61" * (BEFORE - len(left)) + left + body + b"\x61" * (INSIDE - len(body))
            + right + b"\x61" * (AFTER - len(right)))


def shape(candidate: str) -> str:
    if candidate.isdigit():
        return "digits"
    if not any(c.isdigit() for c in candidate):
        return "letters"
    return "hex" if all(c in "0123456789abcdefABCDEF" for c in candidate) else "mixed"


@dataclass
class CharCnn:
    """logit = dense(max over positions of relu(convolution over embedded characters)).

    ``taps[k][code]`` is the contribution of a character k places after a filter's start."""
    taps: np.ndarray                 # [taps, 2 * codes, filters]
    bias: np.ndarray                 # [filters]
    dense: np.ndarray                # [filters]
    offset: float
    slope: float = 1.0               # Platt calibration
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def _convolve(self, x: np.ndarray) -> np.ndarray:
        n = x.shape[1] - _TAPS + 1
        out = self.taps[0][x[:, :n]] + self.bias
        for k in range(1, _TAPS):
            out += self.taps[k][x[:, k:k + n]]
        return out

    def logits(self, windows: list[bytes]) -> np.ndarray:
        out = np.empty(len(windows), dtype=np.float64)
        for at in range(0, len(windows), 512):
            x = np.frombuffer(b"".join(windows[at:at + 512]), np.uint8).reshape(-1, _WIDTH)
            top = np.maximum(self._convolve(x).max(axis=1), 0)
            out[at:at + 512] = top @ self.dense + self.offset
        return out

    def probability(self, windows: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.logits(windows) + self.shift, -30, 30)))


def _masked(windows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Half of the windows lose the characters before the candidate, so that a secret is
    also known without its keyword."""
    out = windows.copy()
    out[rng.random(len(out)) < 0.5, :BEFORE] = 97
    return out


def _split(windows: list[bytes]) -> tuple[list[bytes], list[bytes]]:
    """(to learn from, held back): a quarter by hash is held back, of few at least one; a
    single window serves for both."""
    train = [w for w in windows if zlib.crc32(w) % 4]
    kept = [w for w in windows if zlib.crc32(w) % 4 == 0]
    if not train or not kept:
        order = sorted(windows, key=lambda w: (zlib.crc32(w), w))
        kept = order[::4]
        train = [w for i, w in enumerate(order) if i % 4] or kept
    return train, kept


def _start(rng: np.random.Generator) -> tuple[CharCnn, list[np.ndarray]]:
    """An untrained network and the sums of squared gradients."""
    net = CharCnn((rng.standard_normal((_TAPS, 2 * _CODES, _FILTERS)) * 0.1).astype(np.float32),
                  np.zeros(_FILTERS, np.float32),
                  (rng.standard_normal(_FILTERS) * 0.3).astype(np.float32), 0.0)
    return net, [np.full_like(a, 1e-4) for a in (net.taps, net.bias, net.dense)]


def _labelled(rows: list[tuple[bytes, float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows, labels and weights by which either label counts half."""
    x = np.frombuffer(b"".join(w for w, _ in rows), np.uint8).reshape(-1, _WIDTH)
    y = np.array([v for _, v in rows])
    share = y.mean()
    if share in (0, 1):
        return x, y, np.full(len(y), 0.5)
    return x, y, np.where(y > 0, 0.5 / share, 0.5 / (1 - share))


def _epoch(net: CharCnn, sums: list[np.ndarray], x: np.ndarray, y: np.ndarray, weight: np.ndarray,
           rate: float, rng: np.random.Generator) -> None:
    order = rng.permutation(len(x))
    for at in range(0, len(order), 64):
        rows = order[at:at + 64]
        batch = _masked(x[rows], rng)
        conv = net._convolve(batch)
        where = conv.argmax(axis=1)                                   # [rows, filters]
        top = np.maximum(np.take_along_axis(conv, where[:, None, :], 1)[:, 0], 0)
        logit = top @ net.dense + net.offset
        error = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[rows]) * weight[rows] / len(rows)).astype(np.float32)
        back = error[:, None] * net.dense * (top > 0)
        grads = [np.zeros_like(net.taps), back.sum(0), top.T @ error]
        filters = np.broadcast_to(np.arange(_FILTERS), where.shape)
        for k in range(_TAPS):
            np.add.at(grads[0][k], (np.take_along_axis(batch, where + k, 1), filters), back)
        for value, total, grad in zip((net.taps, net.bias, net.dense), sums, grads, strict=True):
            total += grad ** 2
            value -= rate * grad / np.sqrt(total)
        net.offset -= rate * float(error.sum())


def fit(positives: list[bytes], negatives: list[bytes], epochs: int = 20, rate: float = 0.02,
        seed: int = 11) -> CharCnn | None:
    """None without both labels: then nothing is added to the base findings."""
    if not positives or not negatives:
        return None
    train, kept = [], []
    for y, ws in ((1.0, positives), (0.0, negatives)):
        own, back = _split(ws)
        train += [(w, y) for w in own]
        kept += [(w, y) for w in back]
    rng = np.random.default_rng(seed)
    data = _labelled(train)
    net, sums = _start(rng)
    for _ in range(epochs):
        _epoch(net, sums, *data, rate, rng)
    windows = [w for w, _ in kept]
    _calibrate(net, net.logits(windows), np.array([v for _, v in kept]),
               np.array([_shape_of(w) for w in windows]), np.ones(len(kept)))
    return net


def _shape_of(w: bytes) -> str:
    return shape("".join(chr(c - _CODES + 32) for c in w if c >= _CODES))


def _calibrate(net: CharCnn, logit: np.ndarray, y: np.ndarray, shapes: np.ndarray, n: np.ndarray) -> None:
    """Slope, shift and thresholds from the logits of held-back windows, each counted n times."""
    sure = (n * y).sum()
    target = np.where(y > 0, (sure + 1) / (sure + 2), 1 / (n.sum() - sure + 2))
    a, b = 1.0, 0.0
    for _ in range(200):  # Newton-like steps on two numbers
        p = 1 / (1 + np.exp(-np.clip(a * logit + b, -30, 30)))
        g, h = n * (p - target), n * (p * (1 - p) + 1e-6)
        a -= 0.5 * (g * logit).sum() / ((h * logit ** 2).sum() + 1e-6)
        b -= 0.5 * g.sum() / h.sum()
    net.slope, net.shift = float(max(a, 1e-3)), float(b)
    score = 1 / (1 + np.exp(-np.clip(net.slope * logit + net.shift, -30, 30)))

    def at_recall(chosen: np.ndarray) -> float:
        order = np.argsort(score[chosen], kind="stable")
        upto = np.cumsum(n[chosen][order])
        return float(score[chosen][order][np.searchsorted(upto, math.floor((1 - RECALL) * (upto[-1] - 1)), "right")])

    everywhere = at_recall(y > 0)
    for c in CLASSES:
        own = (y > 0) & (shapes == c)
        net.thresholds[c] = at_recall(own) if n[own].sum() >= 5 else max(everywhere, 0.9)


def _fit_blocks(many: DataFrame, n: int, few: dict[bool, list[bytes]], epochs: int = 20,
                rate: float = 0.02, seed: int = 11) -> CharCnn:
    """``fit`` where the ``n`` windows of one label or both (``many``: label, window) stay in Spark."""
    sc = many.sparkSession.sparkContext
    parts = {label: _split(ws) for label, ws in few.items()}
    beside = [(w, float(label)) for label, (own, _) in parts.items() for w in own]
    back = pd.DataFrame([(label, w) for label, (_, own) in parts.items() for w in own], columns=["label", "window"])
    held = F.crc32("window") % 4 == 0
    blocks = math.ceil(n / BLOCK)

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["label", "window"])
        return pd.DataFrame({"block": rows["block"].iloc[:1], "n": len(rows), "windows": b"".join(rows["window"]),
                             "labels": bytes(rows["label"].astype("uint8"))})

    packed = stage(many.where(~held).withColumn("block", F.pmod(F.xxhash64("window"), F.lit(blocks)))
                   .groupBy("block").applyInPandas(pack, "block long, n long, windows binary, labels binary"), "blocks")

    def flat(net: CharCnn, sums: list[np.ndarray]) -> np.ndarray:
        return np.concatenate([a.ravel() for a in (net.taps, net.bias, net.dense, *sums)] + [[net.offset]])

    def unflat(state: np.ndarray) -> tuple[CharCnn, list[np.ndarray]]:
        sizes = [_TAPS * 2 * _CODES * _FILTERS, _FILTERS, _FILTERS] * 2
        cut = [a.astype(np.float32) for a in np.split(state[:-1], np.cumsum(sizes)[:-1])]
        cut[0], cut[3] = (a.reshape(_TAPS, 2 * _CODES, _FILTERS) for a in (cut[0], cut[3]))
        return CharCnn(*cut[:3], float(state[-1])), cut[3:]

    state = flat(*_start(np.random.default_rng(seed)))
    for k in range(epochs):
        shared = sc.broadcast((state, beside))

        def one_round(batches: Iterator[pd.DataFrame], k: int = k, shared=shared) -> Iterator[pd.DataFrame]:
            total, seen = 0.0, 0
            for batch in batches:
                for block, n, windows, labels in batch.itertuples(index=False):
                    rows = [(windows[i * _WIDTH:(i + 1) * _WIDTH], float(v)) for i, v in enumerate(labels)]
                    net, sums = unflat(shared.value[0])
                    _epoch(net, sums, *_labelled(rows + shared.value[1]), rate, np.random.default_rng([seed, k, block]))
                    total, seen = total + n * flat(net, sums), seen + n
            if seen:
                yield pd.DataFrame({"state": [total.tobytes()], "n": [seen]})

        # one network a task; a few tasks, so that what comes back is bounded
        done = packed.coalesce(32).mapInPandas(one_round, "state binary, n long").collect()
        state = sum(np.frombuffer(r["state"]) for r in done) / sum(r["n"] for r in done)
        shared.destroy()
    net, _sums = unflat(state)

    def judged(rows: pd.DataFrame) -> pd.DataFrame:
        windows = [bytes(w) for w in rows["window"]]
        steps = np.floor(np.clip(net.logits(windows), -30, 30) / STEP).astype(np.int64)
        return pd.DataFrame({"label": rows["label"], "shape": [_shape_of(w) for w in windows], "step": steps})

    scores = many.where(held).mapInPandas(lambda batches: (judged(b) for b in batches),
                                          "label boolean, shape string, step long")
    counted = scores.groupBy("label", "shape", "step").agg(F.count("*").alias("n")).toPandas()
    if len(back):
        counted = pd.concat([counted, judged(back).assign(n=1)])
    _calibrate(net, counted["step"].to_numpy() * STEP, counted["label"].to_numpy(dtype=float),
               counted["shape"].to_numpy(dtype=str), counted["n"].to_numpy(dtype=float))
    return net


def _text(docs: DataFrame):
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def train(docs: DataFrame, sample_docs: int | None = None, sample_class: int | None = None) -> CharCnn | None:
    """Fit on every different window of ``docs``.  Nothing is sampled: ``sample_docs`` and
    ``sample_class`` are accepted for older callers and have no effect."""
    texts = docs.select(_text(docs).alias("text"))

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                spans = candidates(text)
                if spans:
                    base = base_spans(text)
                    rows += [(any(s < b and a < e for s, e, _ in base), window(text, a, b))
                             for c in spans for a, b in slices(*c)]
            yield pd.DataFrame(rows, columns=["label", "window"])

    # written once: the texts are not scanned again for the second label
    found = stage(texts.mapInPandas(windows, "label boolean, window binary").distinct(), "windows")
    n = {r["label"]: r["count"] for r in found.groupBy("label").count().collect()}
    if len(n) < 2:
        return None
    few = {label: sorted(bytes(r["window"]) for r in found.where(F.col("label") == label).select("window").collect())
           for label, rows in n.items() if rows <= FEW}
    if len(few) == 2:
        return fit(few[True], few[False])
    many = found.where(~F.col("label").isin(list(few))) if few else found
    return _fit_blocks(many, sum(rows for label, rows in n.items() if label not in few), few)


def all_spans(texts: list[str], net: CharCnn | None) -> list[list[Span]]:
    """Base spans and those the network adds (kind "cnn": candidates, or their
    parts clear of base spans, one window of which is sure)."""
    out, asked, windows = [], [], []
    for r, text in enumerate(texts):
        base = base_spans(text)
        out.append(base)
        if net is not None:
            for a, b in clear_parts(text, base):
                for s, e in slices(a, b):
                    asked.append((r, a, b, shape(text[s:e])))
                    windows.append(window(text, s, e))
    if windows:
        sure = {(r, a, b): None for (r, a, b, c), p in zip(asked, net.probability(windows), strict=True)
                if p >= net.thresholds[c]}
        for r, a, b in sure:
            out[r] = out[r] + [(a, b, "cnn")]
    rank = {k: i for i, k in enumerate((*KINDS, "cnn"))}
    return [sorted(spans, key=lambda s: (s[0], rank[s[2]])) for spans in out]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def _broadcast(docs: DataFrame, net: CharCnn | None):
    return docs.sparkSession.sparkContext.broadcast(None if net is None else vars(net))


def _network(shared) -> CharCnn | None:
    return None if shared.value is None else CharCnn(**shared.value)


def find_secrets(docs: DataFrame, net: CharCnn | None) -> DataFrame:
    """One row per document row: doc_id, n_assign, n_access, n_hex, n_cnn, base_sha256,
    spans.  Null texts count as empty (no spans, the digest of an empty string); repeated
    rows stay repeated; an empty table gives an empty result; other columns are not read."""
    shared = _broadcast(docs, net)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = all_spans(batch.column(1).to_pylist(), _network(shared))
            base = [joined([s for s in spans if s[2] != "cnn"]) for spans in found]
            counts = [pa.array([sum(k == kind for _, _, k in spans) for spans in found], pa.int64())
                      for kind in (*KINDS, "cnn")]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), *counts,
                pa.array([hashlib.sha256(b.encode()).hexdigest() for b in base], pa.string()),
                pa.array([joined(spans) for spans in found], pa.string()),
            ], names=["doc_id", "n_assign", "n_access", "n_hex", "n_cnn", "base_sha256", "spans"])

    return docs.select("doc_id", _text(docs).alias("text")).mapInArrow(
        scan, f"doc_id {dict(docs.dtypes)['doc_id']}, n_assign long, n_access long, n_hex long, n_cnn long, "
              "base_sha256 string, spans string")


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Train on all of ``docs`` and scan all of it; see find_secrets."""
    return find_secrets(docs, train(docs))


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret replaced by ``mask`` (overlapping spans by one) and n_chars
    set to the new length; all rows stay, null texts stay null."""
    shared = _broadcast(docs, train(docs))

    @F.arrow_udf("string")
    def hide(column: pa.Array) -> pa.Array:
        texts, out = column.to_pylist(), []
        for text, spans in zip(texts, all_spans([t or "" for t in texts], _network(shared)), strict=True):
            if spans:
                parts, at = [], 0
                for start, end, _ in spans:
                    if start >= at:
                        parts += [text[at:start], mask]
                    at = max(at, end)
                text = "".join([*parts, text[at:]])
            out.append(text)
        return pa.array(out, pa.string())

    names = docs.columns
    clean = docs.withColumn("text", hide(F.col("text").cast("string")))
    if "n_chars" in names:
        kind = dict(docs.dtypes)["n_chars"]
        clean = clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                                 .otherwise(F.char_length("text")).cast(kind))
    return clean.select(*[F.col(f"`{c}`") for c in names])
