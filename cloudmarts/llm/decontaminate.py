"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

An item is contaminating a document if at least ``threshold`` (0.8) of the item's distinct
five-word shingles occur in the document.  MinHash of a whole long document says nothing
about a short item (their Jaccard likeness is near 0), so sizes are partitioned: items fall
into classes of similar shingle counts, and for each class the documents are searched in
overlapping windows of that class's length.  A window and an item of its class have similar
sizes, so containment implies a large Jaccard likeness, and one of ``N_HASHES`` single-row
bands collides: with a likeness of 0.3 a miss has probability 0.7^32 (1e-5); an item whose
shingles lie scattered over a document collides in about ten bands over all windows.
Windows are made of grains of eight shingles, too coarse for short items: those of at most
``SHORT`` shingles are looked up shingle by shingle instead, which misses none.  Colliding (document, item) pairs are verified by exact shingle containment over the whole
document.

The items are the stated query set: they are held against all documents in blocks of
bounded bytes; each block is one map-side pass, nothing is shuffled.  Words are runs of
``\\w`` in lower case.  Items with fewer than five words hold no shingle and match nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
THRESHOLD = 0.8
N_HASHES = 32
SHORT = 12                   # shingles up to which an item is looked up exactly
CLASS_RATIO = 1.5            # largest over smallest item of one size class
BLOCK_BYTES = 16_000_000     # benchmark bytes held by a task at a time
_GRAIN = 8                   # shingles of which the minima are shared by all classes
_SPAN = 1 << 16              # shingles handled at a time
_WORD = re.compile(r"\w+")
_rng = np.random.default_rng(20240607)
_MUL = _rng.integers(1, 1 << 63, N_HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, N_HASHES, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint32(0xFFFFFFFF)
_LOW = np.uint32(0xFFFF)
_LOW64 = np.uint64(0xFFFF)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def shingle_hashes(word_hashes: np.ndarray) -> np.ndarray:
    n = len(word_hashes) - SHINGLE_WORDS + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(SHINGLE_WORDS):
        out = (out ^ word_hashes[i:i + n]) * _STEP
        out ^= out >> np.uint64(29)
    return out


def _min_hash(shingles: np.ndarray, i: int) -> np.ndarray:
    return ((shingles * _MUL[i] + _ADD[i]) >> np.uint64(32)).astype(np.uint32)


def _slide(minima: np.ndarray, width: int) -> np.ndarray:
    """Minimum over every run of ``width`` neighbours along the last axis."""
    done, out = 1, minima
    while done * 2 <= width:
        out = np.minimum(out[:, :-done], out[:, done:])
        done *= 2
    if done < width:
        out = np.minimum(out[:, :out.shape[1] - (width - done)], out[:, width - done:])
    return out


class _SizeClass:
    """Items with similar shingle counts and the windows in which they are looked for."""

    def __init__(self, largest: int, items: list[tuple[int, np.ndarray]]):
        self.stride = max(1, largest // (2 * _GRAIN))
        self.width = -(-(largest + self.stride * _GRAIN - 1) // _GRAIN)
        self.common = np.zeros((N_HASHES, 1 << 16), dtype=bool)
        self.keys, self.owners = [], []
        for i in range(N_HASHES):
            values = np.array([_min_hash(s, i).min() for _, s in items], dtype=np.uint32)
            order = np.argsort(values, kind="stable")
            self.keys.append(values[order])
            self.owners.append(np.array([items[o][0] for o in order]))
            self.common[i, values & _LOW] = True  # minima crowd near 0; low bits spread evenly

    def collisions(self, minima: np.ndarray) -> Iterator[tuple[int, int]]:
        """(first grain of a window, item) for each equal band."""
        if minima.shape[1] < self.width:
            minima = np.pad(minima, ((0, 0), (0, self.width - minima.shape[1])), constant_values=_TOP)
        windows = _slide(minima, self.width)
        last = windows.shape[1] - 1
        starts = np.append(np.arange(0, last, self.stride), last)
        windows = windows[:, starts]
        for i in range(N_HASHES):
            hits = np.flatnonzero(self.common[i][windows[i] & _LOW])
            if len(hits):
                a = np.searchsorted(self.keys[i], windows[i, hits], "left")
                b = np.searchsorted(self.keys[i], windows[i, hits], "right")
                for k in np.flatnonzero(a < b):
                    for owner in self.owners[i][a[k]:b[k]]:
                        yield int(starts[hits[k]]), int(owner)


class _ShortItems:
    """Items of few shingles: every shingle, sorted, with its item."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        keys = np.concatenate([s for _, s in items])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.owners = np.repeat([i for i, _ in items], [len(s) for _, s in items])[order]
        self.common = np.zeros(1 << 16, dtype=bool)
        self.common[self.keys & _LOW64] = True

    def hits(self, stream: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places, items): an item for each place of ``stream`` that holds one of its shingles."""
        places = np.flatnonzero(self.common[stream & _LOW64])
        at = np.searchsorted(self.keys, stream[places], "left")
        end = np.searchsorted(self.keys, stream[places], "right")
        while len(places):
            some = at < end
            places, at, end = places[some], at[some], end[some]
            if len(places):
                yield places, self.owners[at]
            at = at + 1


class ContainmentIndex:
    """The signatures of a bounded block of items."""

    def __init__(self, texts: list[str | None], threshold: float = THRESHOLD):
        self.threshold = threshold
        self.grams: list[dict] = []
        self.shingles: list[np.ndarray] = []
        sized = []
        for i, text in enumerate(texts):
            words = words_of(text)
            grams = {tuple(words[j:j + SHINGLE_WORDS]) for j in range(len(words) - SHINGLE_WORDS + 1)}
            found = np.unique(shingle_hashes(_hashes(words)))
            self.grams.append(grams)
            self.shingles.append(found)
            if len(found):
                sized.append((len(found), i))
        self.classes: list[_SizeClass] = []
        sized.sort()
        at = sum(n <= SHORT for n, _ in sized)
        self.short = _ShortItems([(i, self.shingles[i]) for _, i in sized[:at]]) if at else None
        while at < len(sized):
            end = at
            while end < len(sized) and sized[end][0] <= CLASS_RATIO * sized[at][0]:
                end += 1
            self.classes.append(_SizeClass(sized[end - 1][0], [(i, self.shingles[i]) for _, i in sized[at:end]]))
            at = end
        self.reach = max((c.width for c in self.classes), default=1)

    def search(self, texts: list[str | None]) -> list[list[tuple[int, int]]]:
        """For each text the (item, shared distinct shingles) at the threshold or above."""
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        if not self.classes and self.short is None:
            return out
        group: list[tuple[int, list[str]]] = []
        size = 0
        for r, text in enumerate(texts):
            words = words_of(text)
            if len(words) >= SHINGLE_WORDS:
                group.append((r, words))
                size += len(words)
            if size >= _SPAN:
                self._search_group(group, out)
                group, size = [], 0
        if group:
            self._search_group(group, out)
        return out

    def _search_group(self, group: list[tuple[int, list[str]]], out: list) -> None:
        """Texts laid end to end; shingles over a border never count."""
        lengths = np.array([len(w) for _, w in group])
        ends = np.cumsum(lengths)
        starts = ends - lengths
        stream = shingle_hashes(np.concatenate([_hashes(w) for _, w in group]))
        border = (ends[:-1, None] - np.arange(SHINGLE_WORDS - 1, 0, -1)).ravel()
        pairs: set[tuple[int, int]] = set()
        if self.short is not None:
            # places over a border only add pairs that the exact check drops
            for places, items in self.short.hits(stream):
                pairs.update(zip(np.searchsorted(ends, places, "right").tolist(), items.tolist(), strict=True))
        for begin in range(0, len(stream) if self.classes else 0, _SPAN):
            part = stream[begin:begin + _SPAN + self.reach * _GRAIN]
            bad = border[(border >= begin) & (border < begin + len(part))] - begin
            grains = -(-len(part) // _GRAIN)
            minima = np.full((N_HASHES, grains * _GRAIN), _TOP, dtype=np.uint32)
            for i in range(N_HASHES):
                minima[i, :len(part)] = _min_hash(part, i)
            minima[:, bad] = _TOP
            step = minima
            for _ in range(3):  # down to grains of eight
                step = np.minimum(step[:, 0::2], step[:, 1::2])
            for size in self.classes:
                for grain, item in size.collisions(step):
                    first = begin + grain * _GRAIN
                    a = np.searchsorted(ends, first, "right")
                    b = np.searchsorted(starts, first + size.width * _GRAIN, "left")
                    pairs.update((d, item) for d in range(a, min(b, len(group))))
        for d, item in sorted(pairs):
            row, words = group[d]
            own = stream[starts[d]:ends[d] - SHINGLE_WORDS + 1]
            places = np.flatnonzero(np.isin(own, self.shingles[item]))
            seen = {tuple(words[p:p + SHINGLE_WORDS]) for p in places} & self.grams[item]
            if seen and len(seen) >= self.threshold * len(self.grams[item]) - 1e-9:
                out[row].append((item, len(seen)))


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list]:
    """The benchmark's rows, a bounded block at a time."""
    total = items.agg(F.sum(F.octet_length(F.col("text").cast("string"))).alias("b")).head()["b"] or 0
    n = total // block_bytes + 1
    keyed = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    for k in range(n):
        block = keyed if n == 1 else keyed.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        yield [(r["item_id"], r["text"]) for r in block.orderBy("item_id", "text").collect()]


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document row and item at the threshold or above: doc_id, item_id,
    n_item (the item's distinct shingles), n_shared, containment.

    Null or short texts on either side match nothing; repeated rows on either side give
    repeated result rows; an empty side gives an empty result.
    """
    schema = "doc_id long, item_id long, n_item long, n_shared long, containment double"
    spark = docs.sparkSession
    found = None
    for block in _blocks(items, block_bytes):
        shared = spark.sparkContext.broadcast(block)  # at most block_bytes of text

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = ContainmentIndex([t for _, t in shared.value], threshold)
            for batch in batches:
                hits = [(row, item, n) for row, found in enumerate(index.search(batch.column(1).to_pylist()))
                        for item, n in found]
                total = [len(index.grams[item]) for _, item, _ in hits]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array([row for row, _, _ in hits], pa.int64())),
                    pa.array([shared.value[item][0] for _, item, _ in hits], pa.int64()),
                    pa.array(total, pa.int64()), pa.array([n for _, _, n in hits], pa.int64()),
                    pa.array([n / k for (_, _, n), k in zip(hits, total, strict=True)], pa.float64()),
                ], names=["doc_id", "item_id", "n_item", "n_shared", "containment"])

        part = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                           F.col("text").cast("string").alias("text")).mapInArrow(search, schema)
        found = part if found is None else found.union(part)
    return found


def _clean(shared, threshold: float):
    """A filter that is true for texts without an item of the block."""

    @F.arrow_udf("boolean")
    def clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = ContainmentIndex([t for _, t in shared.value], threshold)
        for texts in batches:
            yield pa.array([not hits for hits in index.search(texts.to_pylist())], pa.bool_())

    return clean


def decontaminate(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that contain no item, columns unchanged (null texts stay)."""
    for block in _blocks(items, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        docs = docs.where(_clean(shared, threshold)(F.col("text").cast("string")))
    return docs
