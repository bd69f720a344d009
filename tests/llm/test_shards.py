import zlib

from cloudmarts.llm import shards as h


def test_by_running_sums(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(7)
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    sizes = [len(t.encode()) + 1 for _, t in rows]
    total, before, slots, want = sum(sizes), 0, {}, {}
    for (doc, text), size in zip(rows, sizes, strict=True):
        shard = int((before + size / 2) * 16 // total)
        want[doc] = (size, zlib.crc32(text.encode()), shard, slots.get(shard, 0))
        slots[shard] = slots.get(shard, 0) + 1
        before += size
    got = h.balanced_shards(docs).collect()
    assert {r["doc_id"]: (r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in got} == want


def test_one_id_holds_most_rows(spark):
    docs = spark.createDataFrame([(1, "same")] * 900 + [(i, f"text {i}") for i in range(2, 100)], "doc_id long, text string")
    got = h.balanced_shards(docs).toPandas()
    by_shard = got.groupby("shard")["size"].sum()
    assert len(by_shard) == 16 and by_shard.max() - by_shard.min() <= 20
    for _, own in got.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))


def test_messy_rows(messy, no_docs):
    got = h.balanced_shards(messy, 4).collect()
    assert len(got) == messy.count()
    assert all(r["size"] == 1 and r["text_crc32"] == 0 for r in got if r["doc_id"] in (2, 3))
    assert all(0 <= r["shard"] < 4 for r in got)
    assert h.balanced_shards(no_docs).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = h.balanced_shards(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
