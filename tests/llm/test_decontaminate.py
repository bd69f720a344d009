import random

from cloudmarts.llm import decontaminate as dc


def grams(text):
    words = dc.words_of(text)
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}


def brute(docs, items):
    out = set()
    for d, text in docs:
        own = grams(text)
        for i, item in items:
            want = grams(item)
            if want and len(want & own) >= 0.8 * len(want) - 1e-9:
                out.add((d, i, len(want & own)))
    return out


def test_by_exact_containment(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    for block in (dc.BLOCK_BYTES, 3_000):
        got = dc.contaminated(docs, items, block_bytes=block).collect()
        assert {(r["doc_id"], r["item_id"], r["n_shared"]) for r in got} == want and len(got) == len(want)
    kept = {r["doc_id"] for r in dc.decontaminate(docs, items).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - {d for d, _, _ in want}


def test_edited_short_and_scattered_items_in_long_documents():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(3000)]
    items = [" ".join(rng.choices(vocab, k=n)) for n in (5, 6, 9, 14, 30, 60, 200, 900)]
    docs = []
    for k, item in enumerate(items):
        words = item.split()
        for change in (0, 1, len(words) // 20):
            own = list(words)
            for _ in range(change):
                own[rng.randrange(len(own))] = "changed"
            noise = rng.choices(vocab, k=20_000)
            half = len(own) // 2
            docs.append((k, " ".join(noise[:7000] + own + noise[7000:])))
            docs.append((k, " ".join(noise[:3000] + own[:half] + noise[3000:9000] + own[half:] + noise[9000:])))
    got = dc.ContainmentIndex(items).search([t for _, t in docs])
    want = brute(list(enumerate(t for _, t in docs)), list(enumerate(items)))
    assert {(d, i, n) for d, hits in enumerate(got) for i, n in hits} == want


def test_messy_rows(spark, messy, no_docs):
    items = spark.createDataFrame([(1, "ipsum dolor sit amet lorem ipsum"), (1, "ipsum dolor sit amet lorem ipsum"), (2, None),
                                   (3, ""), (4, "one two three"), (None, "one two three four five")], "item_id long, text string")
    rows = dc.contaminated(messy, items).collect()
    assert sorted((r["doc_id"], r["item_id"] or 0) for r in rows) == [(1, 0), (1, 0), (9, 1), (9, 1)]
    kept = dc.decontaminate(messy, items)
    assert kept.columns == messy.columns and kept.count() == messy.count() - 3
    assert dc.contaminated(no_docs, items).count() == 0
    assert dc.contaminated(messy, items.limit(0)).count() == 0
    assert dc.decontaminate(messy, items.limit(0)).count() == messy.count()


def test_no_short_item_is_missed():
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(5000)]
    items = [" ".join(rng.choices(vocab, k=5 + k % 13)) for k in range(3000)]
    docs = [" ".join([*rng.choices(vocab, k=rng.randrange(40)), item, *rng.choices(vocab, k=40)]) for item in items]
    docs.append("none of " + " ".join(items[0].split()[:4]) + " " + items[1])
    got = dc.ContainmentIndex(items).search(docs)
    assert all(k in {i for i, _ in hits} for k, hits in enumerate(got[:-1]))
    few = list(range(0, 3000, 30))
    want = brute([(d, docs[d]) for d in few], list(enumerate(items)))
    assert {(d, i, n) for d in few for i, n in got[d]} == want
