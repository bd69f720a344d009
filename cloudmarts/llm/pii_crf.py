"""Personal data: fixed patterns plus a skip-chain conditional random field.

Base findings follow four fixed patterns and always stay.  The field's variables are the
tokens (blank-separated) that hold a digit or an ``@``; every other token is outside by
definition and only serves as context.  Neighbouring variables share a chain potential; each
variable also shares a skip potential with the next one in the document that has the same
text, and with the next one of the same shape (digits and letters levelled), so the number of
edges is linear in the text.  Loopy sum-product message passing spreads labels over these
edges, swept forward and backward through each document until its messages settle: a number that is a phone number in one place is one wherever it is repeated, also where
its surroundings keep the pattern from matching.

Trained piecewise on a bounded sample labelled by the base findings: the node potential is a
softmax over hashed features of the token and its neighbours, the edge potentials are smoothed
log ratios of label pairs.  Tokens that a base finding covers are observed during inference.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cloudmarts.llm.components import stage

# The kinds, their patterns and limits.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

LABELS = ("none", *KINDS)
FEATURES = 1 << 12
SAMPLE_DOCS = 20_000
SAMPLE_NODES = 20_000  # of each label, at most
SWEEPS, SETTLED = 100, 1e-6  # a sweep crosses the whole document; most settle in a few
CERTAIN = 0.9
_MARK = re.compile(r"[0-9@]\S*")
_LEVEL = str.maketrans({**{c: "9" for c in "0123456789"}, **{chr(c): "a" for c in range(97, 123)},
                        **{chr(c): "A" for c in range(65, 91)}})

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ outwards, so that a long run of name characters is read once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        rest = _DOMAIN.match(text, at + 1) if start < at else None
        done = rest.end() if rest else at + 1
        if rest:
            yield start, rest.end()
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """(start, end, kind): leftmost, non-overlapping per kind; by start, then kind as listed."""
    found: list[Span] = [(a, b, "email") for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGIT.findall(m.group())) <= 15:
                found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def nodes(text: str) -> list[tuple[int, int]]:
    """Spans of the blank-separated tokens that hold a digit or @."""
    out, done = [], 0
    for m in _MARK.finditer(text):
        start = m.start()
        while start > done and not text[start - 1].isspace():
            start -= 1
        out.append((start, m.end()))
        done = m.end()
    return out


def _word(text: str, at: int, step: int) -> str:
    """The whole token before (step -1) or after (1) place ``at``, over any gap of blanks."""
    size = 32
    while True:
        part = text[max(0, at - size):at] if step < 0 else text[at:at + size]
        words = part.split()
        if len(part) < size or len(words) > 1 or (words and part[0 if step < 0 else -1].isspace()):
            return (words[-1] if step < 0 else words[0]).lower() if words else ""
        size *= 2


def shape(token: str) -> str:
    return token.strip(".,;:!?()[]<>\"'").translate(_LEVEL)


def node_features(text: str, start: int, end: int) -> list[int]:
    token = text[start:end]
    level = shape(token)
    n_digits = sum(c == "9" for c in level)
    names = ("bias", f"shape {level}", f"digits {min(n_digits, 20)}", f"length {min(end - start, 30)}",
             f"at {'@' in token}", f"dots {min(token.count('.'), 4)}", f"dashes {min(token.count('-'), 4)}",
             f"first {level[:1]}", f"plus {token[:1] == '+'}", f"letters {'a' in level or 'A' in level}",
             f"before {shape(_word(text, start, -1))}", f"after {shape(_word(text, end, 1))}",
             f"word before {_word(text, start, -1)}")
    return [zlib.crc32(n.encode()) % FEATURES for n in names]


N_FEATURES = 13


def skips(tokens: list[str]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Edges to the next token with the same text, and to the next one of the same shape."""
    same, alike, seen, shaped = [], [], {}, {}
    for i, token in enumerate(tokens):
        bare = token.strip(".,;:!?()[]<>\"'").lower()
        level = shape(token)
        if bare in seen:
            same.append((seen[bare], i))
        if len(level) >= 6 and level in shaped and shaped[level] != seen.get(bare):
            alike.append((shaped[level], i))
        seen[bare] = shaped[level] = i
    return same, alike


def _graph(text: str, base: list[Span]):
    """(spans, labels, chain edges, skip edges, similarity edges) of one text."""
    spans = nodes(text)
    labels, k = [], 0
    for a, b in spans:
        while k < len(base) and base[k][1] <= a:
            k += 1
        hit = next((s[2] for s in base[max(0, k - 3):k + 4] if s[0] < b and a < s[1]), None)
        labels.append(LABELS.index(hit) if hit else 0)
    chain = [(i - 1, i) for i in range(1, len(spans))
             if not text[spans[i - 1][1]:min(spans[i][0], spans[i - 1][1] + 4)].strip() and spans[i][0] - spans[i - 1][1] <= 3]
    same, alike = skips([text[a:b] for a, b in spans])
    return spans, labels, chain, same, alike


def _depths(n: int, ends: np.ndarray) -> np.ndarray:
    """Edges on the longest way to each node from earlier ones."""
    depth = [0] * n
    for i, j in sorted(ends.tolist()):
        depth[j] = max(depth[j], depth[i] + 1)
    return np.array(depth)


def _components(n: int, ends: np.ndarray) -> np.ndarray:
    """A node of each node's component."""
    root = list(range(n))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for i, j in ends.tolist():
        root[find(j)] = find(i)
    return np.array([find(i) for i in range(n)])


def _levels(keys: np.ndarray) -> list[np.ndarray]:
    """Places of equal keys, by key."""
    order = np.argsort(keys, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(keys[order])) + 1)


class SkipChainCrf:
    def __init__(self, weights: np.ndarray, edges: np.ndarray):
        self.weights = weights  # [features, labels]
        self.edges = edges      # [3 kinds of edges, labels, labels], log potentials

    def posterior(self, unary: np.ndarray, ends: np.ndarray, kinds: np.ndarray, rounds: int = SWEEPS) -> np.ndarray:
        """Loopy sum-product in log space; [nodes, labels].  Every edge leads to a later node.

        A sweep sends the messages to later nodes in the order of the nodes, then those to
        earlier ones backwards, so that evidence crosses a whole document in one sweep; nodes
        of equal depth go together.  A component of the graph leaves once no message of it
        changes by more than SETTLED, at the latest after ``rounds`` sweeps; from the tenth on,
        messages are damped.
        """
        belief = unary.copy()
        if len(ends):
            depth, group = _depths(len(unary), ends), _components(len(unary), ends)[ends[:, 0]]
            up, down = np.zeros((len(ends), len(LABELS))), np.zeros((len(ends), len(LABELS)))
            table = self.edges[kinds]
            steps = [(up, down, ends[:, 0], ends[:, 1], table, _levels(depth[ends[:, 1]])),
                     (down, up, ends[:, 1], ends[:, 0], table.transpose(0, 2, 1), _levels(-depth[ends[:, 0]]))]
            open_ = np.ones(len(unary), dtype=bool)  # by component
            for r in range(rounds):
                change = np.zeros(len(unary))
                for sent, back, source, target, tables, levels in steps:
                    for level in levels:
                        out = (belief[source[level]] - back[level])[:, :, None] + tables[level]
                        top = out.max(axis=1)
                        new = top + np.log(np.exp(out - top[:, None, :]).sum(axis=1))
                        new -= new.max(axis=1, keepdims=True)
                        moved = (new - sent[level]) * (0.5 if r >= 10 else 1.0)
                        sent[level] += moved
                        np.add.at(belief, target[level], moved)
                        np.maximum.at(change, group[level], np.abs(moved).max(axis=1))
                still = open_ & (change > SETTLED)
                if not still.any():
                    break
                if still.sum() < open_.sum():
                    open_ = still
                    steps = [(*step, [kept for level in levels if len(kept := level[open_[group[level]]])])
                             for *step, levels in steps]
        p = np.exp(belief - belief.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)

    def spans(self, texts: list[str]) -> list[list[Span]]:
        """Base spans, and kind_crf for tokens clear of them that are surely of a kind."""
        found = [base_spans(t) for t in texts]
        where, fixed, rows, ends, kinds = [], [], [], [], []
        for r, (text, base) in enumerate(zip(texts, found, strict=True)):
            spans, labels, *edges = _graph(text, base)
            first = len(where)
            where += [(r, a, b) for a, b in spans]
            fixed += labels
            rows += [node_features(text, a, b) for a, b in spans]
            for kind, pairs in enumerate(edges):
                ends += [(first + i, first + j) for i, j in pairs]
                kinds += [kind] * len(pairs)
        if where:
            unary = self.weights[np.array(rows)].sum(axis=1)
            observed = np.array(fixed)
            unary[observed > 0] = -50.0
            unary[observed > 0, observed[observed > 0]] = 0.0
            p = self.posterior(unary, np.array(ends, dtype=np.int64).reshape(-1, 2), np.array(kinds, dtype=np.int64))
            for i in np.flatnonzero((observed == 0) & (p[:, 1:].max(axis=1) >= CERTAIN)):
                r, a, b = where[i]
                text = texts[r]
                while a < b and text[a] in "([<{\"'":
                    a += 1
                while b > a and text[b - 1] in ".,;:!?)]>}\"'#$%&*|":
                    b -= 1
                found[r].append((a, b, LABELS[1 + int(p[i, 1:].argmax())] + "_crf"))
        rank = {k: i for i, k in enumerate((*KINDS, *(f"{k}_crf" for k in KINDS)))}
        return [sorted(s, key=lambda x: (x[0], rank[x[2]])) for s in found]


def _fit_nodes(rows: np.ndarray, labels: np.ndarray, epochs: int = 30, rate: float = 0.5) -> np.ndarray:
    """Softmax regression by AdaGrad; labels weigh as often as they occur."""
    weights = np.zeros((FEATURES, len(LABELS)))
    total = np.full_like(weights, 1e-3)
    rng = np.random.default_rng(3)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), 256):
            batch = order[at:at + 256]
            z = weights[rows[batch]].sum(axis=1)
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(batch)), labels[batch]] -= 1
            grad = np.zeros_like(weights)
            np.add.at(grad, rows[batch], np.repeat(p[:, None, :] / len(batch), N_FEATURES, axis=1))
            grad += 1e-4 * weights
            total += grad ** 2
            weights -= rate * grad / np.sqrt(total) * 0.2
    return weights


def _text(docs: DataFrame):
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_nodes: int = SAMPLE_NODES) -> SkipChainCrf:
    """Fit on about ``sample_docs`` documents (by a hash of the text) and at most
    ``sample_nodes`` distinct nodes of each label.  Without nodes: nothing is ever added."""
    part = max(1, docs.count() // sample_docs)
    some = docs.select(_text(docs).alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(part)) == 0)

    def facts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                spans, labels, *edges = _graph(text, base_spans(text))
                for (a, b), y in zip(spans, labels, strict=True):
                    rows.append((-1, y, 0, np.array(node_features(text, a, b), dtype="<u2").tobytes()))
                for kind, pairs in enumerate(edges):
                    rows += [(kind, labels[i], labels[j], None) for i, j in pairs]
            yield pd.DataFrame(rows, columns=["kind", "a", "b", "features"])

    found = some.mapInPandas(facts, "kind int, a int, b int, features binary")
    counted = stage(found.groupBy("kind", "a", "b", "features").agg(F.count("*").alias("n")), "pii-facts")
    pairs = np.ones((3, len(LABELS), len(LABELS)))
    for r in counted.where("kind >= 0").collect():  # at most 75 rows
        pairs[r["kind"], r["a"], r["b"]] += r["n"]
    rows, labels = [], []
    for y in range(len(LABELS)):
        for r in (counted.where((F.col("kind") < 0) & (F.col("a") == y))
                  .orderBy(F.xxhash64("features"), "features").limit(sample_nodes).select("features").collect()):
            rows.append(np.frombuffer(r["features"], dtype="<u2"))
            labels.append(y)
    edges = np.zeros_like(pairs)
    for kind in range(3):
        both = pairs[kind] + pairs[kind].T
        p = both / both.sum()
        edges[kind] = np.clip(np.log(p / np.outer(p.sum(1), p.sum(0))), -3, 3)
    if not rows:
        weights = np.zeros((FEATURES, len(LABELS)))
        weights[zlib.crc32(b"bias") % FEATURES, 0] = 20.0
        return SkipChainCrf(weights, np.zeros_like(edges))
    return SkipChainCrf(_fit_nodes(np.array(rows, dtype=np.int64), np.array(labels)), edges)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def find_pii(docs: DataFrame, crf: SkipChainCrf) -> DataFrame:
    """One row per document row: doc_id, n_email, n_ip, n_card, n_phone, n_crf, base_sha256,
    spans.  Null texts count as empty (no spans, the digest of an empty string); repeated
    rows stay repeated; an empty table gives an empty result; other columns are not read."""
    shared = docs.sparkSession.sparkContext.broadcast((crf.weights, crf.edges))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = SkipChainCrf(*shared.value)
        for batch in batches:
            found = model.spans(batch.column(1).to_pylist())
            base = [[s for s in spans if s[2] in KINDS] for spans in found]
            counts = [pa.array([sum(k == kind for _, _, k in spans) for spans in base], pa.int64()) for kind in KINDS]
            added = pa.array([len(s) - len(b) for s, b in zip(found, base, strict=True)], pa.int64())
            yield pa.RecordBatch.from_arrays([
                batch.column(0), *counts, added,
                pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base], pa.string()),
                pa.array([joined(s) for s in found], pa.string()),
            ], names=["doc_id", *(f"n_{k}" for k in KINDS), "n_crf", "base_sha256", "spans"])

    counts = ", ".join(f"n_{k} long" for k in (*KINDS, "crf"))
    return docs.select("doc_id", _text(docs).alias("text")).mapInArrow(
        scan, f"doc_id {dict(docs.dtypes)['doc_id']}, {counts}, base_sha256 string, spans string")


def scan_pii(docs: DataFrame) -> DataFrame:
    """Train on a sample of ``docs`` and scan all of it; see find_pii."""
    return find_pii(docs, train(docs))
