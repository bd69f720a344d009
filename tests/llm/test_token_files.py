import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cloudmarts.llm import token_files as f
from cloudmarts.llm.queries import QUERIES


def reader(block):
    return lambda at, n: block[at:at + n]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1 << 40), max_size=700), st.integers(0, 62), st.data())
def test_sequences_come_back(values, shift, data):
    values = sorted(min(v << shift, (1 << 64) - 1) for v in values)
    block = f.ef_encode(np.array(values, np.uint64))
    ef = f.EliasFano(reader(b"head" + block + b"tail"), 4)
    assert ef.end == 4 + len(block) and ef.values(0, len(values)).tolist() == values
    first = data.draw(st.integers(0, len(values)))
    stop = data.draw(st.integers(first, len(values)))
    assert ef.values(first, stop).tolist() == values[first:stop]


def test_reading_one_value_reads_little_and_space_is_near_minimal():
    rng = np.random.default_rng(5)
    values = np.cumsum(rng.integers(0, 1000, 200_000)).astype(np.uint64)
    block, read = f.ef_encode(values), []
    assert len(block) * 8 / len(values) < 2 + np.log2(values[-1] / len(values)) + 1  # bits a value
    ef = f.EliasFano(lambda at, n: (read.append(n), block[at:at + n])[1])
    for i in (0, 255, 256, 100_000, 199_999):
        del read[:]
        assert ef.values(i, i + 1)[0] == values[i] and sum(read) < 300
    with pytest.raises(IndexError):
        ef.values(5, 200_001)


def test_low_bits_beyond_one_slice():
    values = np.arange(70_000, dtype=np.uint64) * 1001
    ef = f.EliasFano(reader(f.ef_encode(values)))
    assert (ef.values(0, 70_000) == values).all()


def expected(texts):
    """(doc_id, start, n_tokens, crc) in ascending (doc_id, tie) order from the library itself."""
    from tokenizers import Tokenizer

    t, at, rows = Tokenizer.from_file(f.default_vocabulary()), 0, []
    for doc_id, text in texts:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        rows.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return rows


def test_query_is_a_round_trip(spark):
    sf = "/root/testdata/sf0.001"
    rows = QUERIES["op11_token_files"](spark, sf).collect()
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows) == expected(docs)


@pytest.mark.parametrize("width", [2, 4])
def test_any_document_is_read_by_itself(spark, width):
    texts = [(i * 7 - 300, f"text {i} " * (i % 9)) for i in range(120)]
    shards = f.write_token_files(spark.createDataFrame(texts, "doc_id long, text string").repartition(5), width=width)
    at = 0
    for s in sorted(shards.collect(), key=lambda s: s["shard"]):
        assert (s["docs_before"], s["bytes_ids"]) == (at, s["ids"] * width)
        shard = f.Shard(s["folder"], s["name"])
        assert shard.doc_ids(0, shard.n) == [i for i, _ in texts[at:at + shard.n]]
        want = expected(texts[at:at + shard.n])
        for i in range(shard.n):
            ids = shard.document(i)
            assert zlib.crc32(ids.astype("<u4")) == want[i][3] and shard.offsets(i, i + 1)[0] == want[i][1]
        shard.close()
        at += s["docs"]
    assert at == len(texts)
    blocks = f.read_token_files(spark, shards, block_ids=7).collect()  # most documents span blocks
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in blocks) == expected(texts)
    assert sorted(r["position"] for r in blocks) == list(range(len(texts)))


def test_messy_rows(spark, messy, no_docs):
    shards = f.write_token_files(messy)
    rows = f.read_token_files(spark, shards).orderBy("position").collect()
    assert len(rows) == messy.count()
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    by_id = {r["doc_id"]: r for r in rows}
    for doc_id, text in ((r["doc_id"], r["text"]) for r in messy.collect()):
        if doc_id not in (None, 1):
            assert expected([(doc_id, text)])[0][2:] == (by_id[doc_id]["n_tokens"], by_id[doc_id]["ids_crc32"])
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    empty = f.write_token_files(no_docs)
    assert empty.count() == 0 and f.read_token_files(spark, empty).count() == 0


def test_a_repeated_write_leaves_the_same_files(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(50)], "doc_id long, text string")
    first = f.write_token_files(docs, str(tmp_path)).orderBy("shard").collect()
    before = {p.name: p.read_bytes() for p in tmp_path.iterdir() if p.suffix in (".ids", ".ef")}
    assert first == f.write_token_files(docs, str(tmp_path)).orderBy("shard").collect()
    assert before == {p.name: p.read_bytes() for p in tmp_path.iterdir() if p.suffix in (".ids", ".ef")}
    assert not any(p.name.startswith("_attempt") for p in tmp_path.iterdir())


def test_copies_under_one_id_fill_many_shards(spark):
    docs = spark.createDataFrame([(1, "same text")] * 4000 + [(i, "x") for i in range(2, 50)], "doc_id long, text string")
    shards = f.write_token_files(docs.repartition(6)).collect()
    assert max(s["docs"] for s in shards) < 1500
