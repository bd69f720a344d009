"""Periodic runs of words by block convolution.

A run is a stretch of words with smallest period q and length of at least max(24, 3q) that no
neighbouring word extends.  For every scale B = 8, 16, 32, ... a text is cut in blocks of B
words.  A run with a period of B to 2B - 1 (at the first scale: 1 to 15) is long enough to hold
a whole block together with its next copy, so the block occurs again, without a mismatch, in the
window that follows it at the distance of the period.  All distances of all blocks of a scale
are tried at once: the squared differences of a block and its window,

    sum (x_i - y_(i+d))^2 = sum x_i^2 + sum y_(i+d)^2 - 2 sum x_i y_(i+d),

need one correlation, which a number-theoretic transform gives in whole numbers modulo a prime.
A sum of zero is an occurrence; none is missed, and a sum that is a multiple of the prime by
chance (one in two thousand million) fails the comparison that follows.  Distances are
seeds: neighbouring blocks with the same distance form a chain, and the words around a chain are
compared at that distance for the run's exact ends.  Work is about n log^2 n for n words.

Blocks of many texts are transformed together; a text of any length is taken whole, in slices of
bounded memory.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_LENGTH = 24
LEAST_PERIODS = 3
FIRST_SCALE = 8
PRIME = 2013265921  # 15 * 2^27 + 1: transforms of up to 2^27 points
_ROOT = 31          # generates the units modulo PRIME
_CELLS = 1 << 20    # numbers transformed at a time
_BATCH_BYTES = 2 << 20
_P = np.uint64(PRIME)


def _mod(x: np.ndarray) -> np.ndarray:
    return x - (x // _P) * _P  # divides by a constant, which is faster than a remainder


@lru_cache(maxsize=64)
def _powers(n: int, inverse: bool) -> np.ndarray:
    """The first n / 2 powers of an n-th root of one (or of its inverse), as a column."""
    root = pow(_ROOT, (PRIME - 1) // n, PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    powers = np.ones(1, np.uint64)
    while len(powers) < n // 2:
        powers = np.concatenate([powers, _mod(powers * np.uint64(pow(root, len(powers), PRIME)))])
    return powers[:, None]


def ntt(a: np.ndarray) -> np.ndarray:
    """The transform of every column of ``a`` (numbers below PRIME), in bit-reversed order."""
    n, columns = a.shape
    half = n // 2
    while half:
        pairs = a.reshape(-1, 2, half, columns)
        u, v = pairs[:, 0], pairs[:, 1]
        out = np.empty_like(pairs)
        s = u + v
        np.minimum(s, s - _P, out=out[:, 0])  # s - PRIME wraps to a large number where s < PRIME
        out[:, 1] = _mod((u + (_P - v)) * _powers(2 * half, False))
        a, half = out.reshape(n, columns), half // 2
    return a


def inverse_ntt(a: np.ndarray) -> np.ndarray:
    """n times the columns whose transforms, in bit-reversed order, are ``a``."""
    n, columns = a.shape
    half = 1
    while half < n:
        pairs = a.reshape(-1, 2, half, columns)
        u, v = pairs[:, 0], _mod(pairs[:, 1] * _powers(2 * half, True))
        out = np.empty_like(pairs)
        s, t = u + v, u + (_P - v)
        np.minimum(s, s - _P, out=out[:, 0])
        np.minimum(t, t - _P, out=out[:, 1])
        a, half = out.reshape(n, columns), half * 2
    return a


def block_matches(words: np.ndarray, starts: np.ndarray, block: int, first: int, distances: int) -> tuple:
    """(block, distance) pairs, as two arrays, such that the block at ``starts[block]`` occurs
    again ``distance`` words on, for the distances from ``first`` on.  ``words`` are numbers
    below PRIME; distances that reach beyond the array are not matched."""
    size = 1
    while size < block + distances - 1:  # the cyclic part beyond it wraps onto unread places
        size *= 2
    found_blocks, found_distances = [], []
    reach = np.arange(distances + block - 1)
    points = np.uint64(size % PRIME)
    step = max(1, _CELLS // size)
    for at in range(0, len(starts), step):
        own = starts[at:at + step]
        x = np.zeros((size, len(own)), np.uint64)
        x[:block] = words[own + np.arange(block - 1, -1, -1)[:, None]]  # reversed: a convolution correlates
        places = own + first + reach[:, None]
        inside = places < len(words)
        y = np.zeros((size, len(own)), np.uint64)
        y[:len(reach)] = np.where(inside, words[np.minimum(places, len(words) - 1)], np.uint64(0))
        squares = np.zeros((len(reach) + 1, len(own)), np.uint64)
        np.cumsum(_mod(y[:len(reach)] * y[:len(reach)]), axis=0, out=squares[1:])
        ours = _mod(x[:block] * x[:block]).sum(axis=0)
        both = _mod(squares[block:] - squares[:distances] + ours)
        cross = inverse_ntt(_mod(ntt(x) * ntt(y)))[block - 1:block - 1 + distances]
        twice = cross + cross
        zero = _mod(both * points) == np.minimum(twice, twice - _P)
        zero &= inside[block - 1:]
        d, b = np.nonzero(zero)
        found_blocks.append(b + at)
        found_distances.append(d + first)
    return np.concatenate(found_blocks or [np.zeros(0, np.int64)]), np.concatenate(
        found_distances or [np.zeros(0, np.int64)])


def find_runs(words: np.ndarray, bounds: Sequence[int], least: int = LEAST_LENGTH,
              periods: int = LEAST_PERIODS) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text, by start and period.  ``words`` are the
    word numbers of all texts, text k from ``bounds[k]`` up to ``bounds[k + 1]``.

    A scale finds every run that holds a block, its copy and whatever lies between: ``least`` of
    at least 24 and ``periods`` of at least 3 make sure of that.
    """
    if least < 3 * FIRST_SCALE or periods < 3:
        raise ValueError("runs this short need not hold a block and its copy")
    bounds = np.asarray(bounds, np.int64)
    sizes = np.diff(bounds)
    found: list[dict[tuple[int, int], int]] = [{} for _ in sizes]
    block = FIRST_SCALE
    while True:
        first, distances = (1, 2 * block - 1) if block == FIRST_SCALE else (block, block)
        texts = np.flatnonzero(sizes >= max(least, periods * first))
        if not len(texts):
            break
        per_text = sizes[texts] // block
        owner = np.repeat(texts, per_text)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        starts = bounds[owner] + nth * block
        b, d = block_matches(words, starts, block, first, distances)
        inside = starts[b] + block + d <= bounds[owner[b] + 1]
        b, d = b[inside], d[inside]
        for text, distance, begin, end in _chains(owner[b], d, starts[b], block):
            if end - begin + 2 * (block - 1) >= (periods - 1) * distance:
                _extend(words, int(bounds[text]), int(bounds[text + 1]), begin, end, distance, block,
                        least, periods, found[text])
        block *= 2
    return [sorted((s - int(low), length, q) for (s, length), q in own.items())
            for own, low in zip(found, bounds[:-1], strict=True)]


def _chains(owner: np.ndarray, distance: np.ndarray, start: np.ndarray, block: int) -> Iterator[tuple]:
    """Neighbouring matched blocks of one text at one distance, as (text, distance, begin, end)."""
    if not len(owner):
        return
    order = np.lexsort((start, distance, owner))
    owner, distance, start = owner[order], distance[order], start[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (distance[1:] != distance[:-1]) | (start[1:] != start[:-1] + block)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(owner)) - 1
    yield from zip(owner[heads].tolist(), distance[heads].tolist(), start[heads].tolist(),
                   (start[tails] + block).tolist(), strict=True)


def _extend(words: np.ndarray, low: int, high: int, begin: int, end: int, q: int, block: int, least: int,
            periods: int, found: dict[tuple[int, int], int]) -> None:
    """Add the runs around the chain of blocks from ``begin`` to ``end`` at distance ``q``.

    A chain inside a run whose period divides q is that run again.  The blocks before and after
    a chain do not match, so its words' ends lie within one block of it.
    """
    if any(q % p == 0 and s <= begin and end + q <= s + length for (s, length), p in found.items()):
        return
    a, b = max(low, begin - block), min(high - q, end + block)
    same = np.concatenate([[False], words[a:b] == words[a + q:b + q], [False]])
    edges = np.flatnonzero(same[1:] != same[:-1]) + a
    for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        length = e - s + q
        if length >= max(least, periods * q):
            found.setdefault((s, length), q)  # smaller periods came first


def summary(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> tuple:
    """(n_runs, start, length, period, exponent_milli, runs_sha256, collapsed text) of one text: the
    run of the most periods (the first, then the shortest period, among equals), and the text without
    every word that lies in a run after its first period."""
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    best = (None,) * 4
    if runs:
        top = runs[0]
        for run in runs[1:]:  # whole numbers: length / period compared exactly; runs are by start, period
            if run[1] * top[2] > top[1] * run[2]:
                top = run
        best = (*top, 1000 * top[1] // top[2])
        drop = np.zeros(len(words) + 1, np.int64)
        for s, length, q in runs:
            drop[s + q] += 1
            drop[s + length] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0).tolist()]
    return (len(runs), *best, hashlib.sha256(lines.encode()).hexdigest(), b" ".join(words))


def _number(texts: Sequence[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts, and where each text begins and the last ends."""
    known: dict[bytes, int] = {}
    numbers = np.fromiter((known.setdefault(w, len(known)) for own in texts for w in own), np.uint64,
                          sum(map(len, texts)))
    return numbers, np.cumsum([0, *map(len, texts)])


def periodic_runs(docs: DataFrame, text_col: str = "text", collapsed_text: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_runs, start, length, period, exponent_milli (of the run
    with the most periods; null without a run), runs_sha256, collapsed_sha256, and with
    ``collapsed_text`` the collapsed text itself.

    Words are what lies between blanks (space, tab, line end, vertical tab, form feed, carriage
    return).  Null and blank texts have no word and no run; repeated rows give a row each; an
    empty table gives an empty result; other columns are not read.
    """
    key = dict(docs.dtypes)["doc_id"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(v.as_buffer()) if v.is_valid else 0 for v in batch.column(1)], np.int64)
            group = np.cumsum(sizes) // _BATCH_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows] if batch.num_rows else [0]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                part = batch.slice(a, b - a)
                # splitting bytes knows these six blanks and no others
                texts = [(t or "").encode().split() for t in part.column(1).to_pylist()]
                found = find_runs(*_number(texts))
                rows = [summary(w, r) for w, r in zip(texts, found, strict=True)]
                n_runs, start, length, period, milli, digest, kept = zip(*rows)
                columns = [part.column(0), *(pa.array(c, pa.int64()) for c in (n_runs, start, length, period, milli)),
                           pa.array(digest), pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
                if collapsed_text:
                    columns.append(pa.array([k.decode() for k in kept]))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
             *(["collapsed_text"] if collapsed_text else [])]
    types = [key, *["long"] * 5, *["string"] * (len(names) - 6)]
    return docs.select("doc_id", F.col(text_col).cast("string").alias("text")).mapInArrow(
        scan, ", ".join(f"`{n}` {t}" for n, t in zip(names, types, strict=True)))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth document by the checksum h of its id repeats a stretch
    up to its end: word i from a on becomes word a + (i - a) mod p, with g = h / 10, a = g mod n
    and p = 1 + (n - a) / (3 + g mod 8), all in whole numbers.  Null ids are left as they are."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    planted = F.expr("""array_join(transform(_words, (w, i) -> CASE WHEN i < _a THEN w
                        ELSE element_at(_words, CAST(_a + (i - _a) % _p + 1 AS INT)) END), ' ')""")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), h.alias("_h"))
    picked = F.col("_h").isNotNull() & (F.col("_h") % 10 == 0)
    rows = rows.withColumn("_words", F.when(picked, words)).withColumn("_n", F.size("_words").cast("long"))
    rows = rows.withColumn("_g", F.expr("_h div 10")).withColumn("_a", F.when(F.col("_n") > 0, F.expr("_g % _n")))
    rows = rows.withColumn("_p", F.expr("1 + (_n - _a) div (3 + _g % 8)"))
    return rows.select("doc_id", F.when(picked & (F.col("_n") > 0), planted).otherwise(F.col("text")).alias("text"))
