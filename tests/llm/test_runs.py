import hashlib
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cloudmarts.llm import runs as r
from cloudmarts.llm.queries import QUERIES


def brute_runs(words):
    """Every period's maximal stretches; a stretch counts for its smallest period."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        s = 0
        while s < n - q:
            e = s
            while e < n - q and words[e] == words[e + q]:
                e += 1
            if e - s + q >= max(24, 3 * q):
                found.setdefault((s, e - s + q), q)
            s = max(e, s + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def brute_row(words):
    found = brute_runs(words)
    best = max(found, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2]), default=None)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def one(words):
    numbers = np.array(words, np.uint64)
    return r.find_runs(numbers, [0, len(words)])[0]


@pytest.mark.parametrize("size", [2, 8, 64, 1024])
def test_transform_multiplies_polynomials(size):
    rng = np.random.default_rng(size)
    x, y = (rng.integers(0, r.PRIME, (size, 3), dtype=np.uint64) for _ in range(2))
    got = r.inverse_ntt(r._mod(r.ntt(x) * r.ntt(y)))
    for c in range(3):
        want = [0] * size
        for i in range(min(size, 40)):
            for j in range(size):
                want[(i + j) % size] += int(x[i, c]) * int(y[j, c])
        if size <= 40:
            assert got[:, c].tolist() == [w * size % r.PRIME for w in want]
    back = r.inverse_ntt(r.ntt(x))
    assert (back == r._mod(x * np.uint64(size))).all()


def test_block_matches_against_slices():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 2, 400).astype(np.uint64)
    for block, first, distances in ((8, 1, 15), (16, 16, 16), (32, 32, 32)):
        starts = np.arange(0, 400 - block, block)
        b, d = r.block_matches(words, starts, block, first, distances)
        want = {(i, x) for i, s in enumerate(starts.tolist()) for x in range(first, first + distances)
                if s + x + block <= 400 and (words[s:s + block] == words[s + x:s + x + block]).all()}
        assert set(zip(b.tolist(), d.tolist())) == want


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.integers(1, 12)), max_size=8))
def test_runs_of_repeated_pieces(pieces):
    words = [w for piece, times in pieces for w in piece * times]
    assert one(words) == brute_runs(words)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 60), st.integers(0, 30), st.integers(0, 30), st.integers(60, 260))
def test_edges_of_a_single_run(q, before, after, length):
    """Lengths around three periods, at any place of the block grid."""
    words = [1000 + i for i in range(before)] + [i % q for i in range(length)] + [2000 + i for i in range(after)]
    assert one(words) == brute_runs(words)


def test_words_of_period_structure():
    a, b = [0], [0, 1]
    while len(b) < 3000:
        a, b = b, b + a
    assert one(b[:3000]) == brute_runs(b[:3000])
    thue = [bin(i).count("1") % 2 for i in range(2000)]
    assert one(thue) == brute_runs(thue) == []
    nested = ([1, 2, 3] * 10 + [4]) * 9 + [5] + ([1, 2, 3] * 10 + [4]) * 4
    assert one(nested) == brute_runs(nested)


def test_a_chance_multiple_of_the_prime_is_no_run(monkeypatch):
    monkeypatch.setattr(r, "block_matches", lambda words, starts, block, first, distances: tuple(
        np.array(x) for x in zip(*[(i, d) for i in range(len(starts)) for d in range(first, first + distances)])))
    rng = np.random.default_rng(1)
    words = [*rng.integers(0, 50, 100).tolist(), *([1, 2, 3, 4, 5] * 9), *rng.integers(0, 50, 100).tolist()]
    assert one(words) == brute_runs(words)


def test_many_texts_at_once_do_not_mix():
    texts = [[1, 2] * 20, [], [1, 2] * 20, [7] * 23, [7] * 24, list(range(100))]
    words = np.array([w for t in texts for w in t], np.uint64)
    got = r.find_runs(words, np.cumsum([0, *map(len, texts)]))
    assert got == [brute_runs(t) for t in texts]


@pytest.mark.parametrize("words", [[5] * 200_000, list(range(1000)) * 200, [1, 1, 1, 2] * 40_000])
def test_very_long_texts(words):
    began = time.monotonic()
    found = one(words)
    assert len(found) == 1 and found[0][:2] == (0, len(words))
    assert time.monotonic() - began < 60


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = {x["doc_id"]: tuple(x)[1:] for x in QUERIES["op13_runs"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    blanks = " \t\n\x0b\x0c\r"
    for d in docs:
        words = "".join(" " if c in blanks else c for c in d["text"] or "").split(" ")
        assert got[d["doc_id"]] == brute_row(planted(d["doc_id"], [w for w in words if w])), d["doc_id"]
    assert len(got) == len(docs) and sum(x[0] > 0 for x in got.values()) > 5


def test_messy_rows(spark, messy, no_docs):
    rows = r.periodic_runs(messy, collapsed_text=True).collect()
    assert len(rows) == messy.count()
    by = {x["doc_id"]: x for x in rows}
    assert by[2]["n_runs"] == by[3]["n_runs"] == by[4]["n_runs"] == 0 and by[2]["start"] is None
    assert (by[9]["start"], by[9]["length"], by[9]["period"]) == (0, 150_000, 5)
    assert by[9]["collapsed_text"] == "lorem ipsum dolor sit amet"
    assert r.periodic_runs(no_docs).count() == 0
    assert r.with_planted_runs(messy).count() == messy.count() and r.with_planted_runs(no_docs).count() == 0


def test_blanks_are_six(spark):
    text = "\x1c".join(["a"] * 30) + " " + "b\u00a0" * 30 + " " + "c\x0b\x0c\r\n\t " * 30
    row = r.periodic_runs(spark.createDataFrame([(1, text)], "doc_id long, text string")).head()
    assert (row["start"], row["length"], row["period"]) == (2, 30, 1)
