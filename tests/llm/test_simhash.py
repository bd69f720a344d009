import random

import pytest
import xxhash

from cloudmarts.llm import simhash as s
from cloudmarts.llm.components import connected_components


def brute_roots(pairs):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


def brute_print(text, n=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \t", "One", "a b", "A b\u00a0c d\x0be É", "x y z x y z x y z", "w " * 70_000])
def test_fingerprint_is_the_bitwise_majority(text):
    assert s.simhash(text) == brute_print(text)


def test_components_by_union_find(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(400), rng.randrange(400)) for _ in range(230)] + [(1000 + i, 1001 + i) for i in range(60)]
    pairs += [(5000, 5001 + i) for i in range(100)] + [(7, 7), (7, None)]
    got = connected_components(spark.createDataFrame(pairs, "u long, v long"))
    want = brute_roots((a, b) for a, b in pairs if b is not None and a != b)
    assert {r["node"]: r["root"] for r in got.collect()} == want
    assert got.count() == len(want)


@pytest.mark.parametrize(("distance", "pair_limit"), [(1, 8), (2, 2), (2, 64)])
def test_links_reach_what_all_pairs_reach(spark, distance, pair_limit):
    rng = random.Random(pair_limit)
    prints = set()
    for family, size in [(rng.getrandbits(64), n) for n in [1] * 60 + [3] * 20 + [40, 120]]:
        for _ in range(size):
            x = family
            for _ in range(rng.randrange(4)):
                x ^= 1 << rng.randrange(64)
            prints.add(x - (1 << 64) if x >> 63 else x)
    prints = sorted(prints)
    want = brute_roots((a, b) for i, a in enumerate(prints) for b in prints[i + 1:]
                       if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= distance)
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    got = connected_components(s.fingerprint_links(frame, distance, pair_limit))
    assert {r["node"]: r["root"] for r in got.collect()} == want


def test_groups_and_dedup_by_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    prints = {i: brute_print(t) for i, t in texts.items()}
    ids = sorted(prints)
    roots = brute_roots((a, b) for i, a in enumerate(ids) for b in ids[i:] if (prints[a] ^ prints[b]).bit_count() <= 2)
    got = s.simhash_groups(docs).select("doc_id", s.fingerprint_hex().alias("f"), "component_id").collect()
    assert {r["doc_id"]: (r["f"], r["component_id"]) for r in got} == {i: (f"{prints[i]:016x}", roots[i]) for i in ids}
    kept = s.dedup(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in ids if roots[i] == i}


def test_messy_rows(messy, no_docs):
    rows = s.simhash_groups(messy).collect()
    assert len(rows) == messy.count()
    wordless = [r for r in rows if r["fp"] == 0 and r["doc_id"] in (2, 3, 4, None)]
    assert {r["component_id"] for r in wordless} == {2} and len(wordless) == 4
    kept = s.dedup(messy)
    assert kept.columns == messy.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(1) == 2 and ids.count(2) == 1 and ids.count(None) == 1 and 3 not in ids
    assert s.simhash_groups(no_docs).count() == 0 and s.dedup(no_docs).count() == 0


def test_dedup_fingerprints_once_and_keeps_texts_in_place(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    calls, real = [], s.with_fingerprint
    monkeypatch.setattr(s, "with_fingerprint", lambda *a, **k: calls.append(1) or real(*a, **k))
    plan = s.dedup(docs)._jdf.queryExecution().executedPlan().toString()
    assert len(calls) == 1 and "ArrowEvalPython" not in plan  # the staged texts carry it
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Window" not in plan


def test_ties_under_one_id_keep_the_first_by_columns(spark):
    rows = [(1, "same words in all of these", "z"), (1, "same words in all of these", "b"), (1, "same words in all of these", "c"),
            (None, "nobody owns this text at all", "y"), (None, "nobody owns this text at all", "x")]
    got = s.dedup(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)).collect()
    assert sorted((r["doc_id"] or 0, r["source"]) for r in got) == [(0, "x"), (1, "b")]
