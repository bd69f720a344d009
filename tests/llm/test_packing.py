import functools
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cloudmarts.llm import packing as p


@pytest.fixture(scope="module")
def reference_tokens():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: [*t.encode(text, add_special_tokens=False).ids, 2]


def test_ids_are_those_of_the_tokenizers_library(spark, reference_tokens):
    encoder = p.load_encoder(p.default_vocabulary())
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += ["", " ", "\r\n\t  x", "it's we'll <|endoftext|> 漢字 \U0001f600 ſK", "\u00a0\u2003 a\x85b", "é" * 5000]
    for text in texts:
        assert [*encoder.encode_ordinary(text), 2] == reference_tokens(text)


@functools.cache
def both_encoders():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t, p.load_encoder(p.default_vocabulary())


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_ids_of_any_text(text):
    t, e = both_encoders()
    assert e.encode_ordinary(text) == t.encode(text, add_special_tokens=False).ids


def test_cut():
    assert p.cut(1, 4) == [(0, 1)] and p.cut(4, 4) == [(0, 4)]
    assert p.cut(10, 4) == [(0, 2), (2, 4), (6, 4)] and p.cut(8, 4) == [(0, 4), (4, 4)]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 300), max_size=25))
def test_plan_holds_every_piece_once_and_is_near_the_bound(histogram):
    kinds = p.plan(histogram, 40, rounds=120)
    got = Counter()
    for config, n in kinds:
        assert sum(length * k for length, k in config.items()) <= 40
        for length, k in config.items():
            got[length] += n * k
    assert got == Counter(histogram)
    first_fit: dict = {}
    p._best_fit(first_fit, dict(histogram), 40)
    assert sum(n for _, n in kinds) <= sum(first_fit.values()) * 1.02 + 2


def test_plan_solves_what_greedy_misses():
    # 4 + 4 + 2 fills ten; greedy by size takes 6 + 4 first and leaves twos alone
    kinds = p.plan({6: 100, 4: 100, 5: 200}, 10)
    assert sum(n for _, n in kinds) == 200


def check_rows(rows, texts, tokens, capacity):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc, text in texts.items():
        ids = [i for r in sorted(by_doc[doc], key=lambda r: r["piece"]) for i in np.frombuffer(r["ids"], "<u4")]
        assert ids == tokens(text or "")
        assert [r["piece"] for r in sorted(by_doc[doc], key=lambda r: r["start"])] == list(range(len(by_doc[doc])))
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] == len(r["ids"]) // 4
            at += r["length"]
        assert at <= capacity
    return len(by_sequence)


def test_round_trip(spark, reference_tokens):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    rows = p.pack(docs).collect()
    n = check_rows(rows, {r["doc_id"]: r["text"] for r in docs.collect()}, reference_tokens, 1024)
    assert n <= -(-sum(r["length"] for r in rows) // 1024) * 1.01 + 2


def test_messy_rows(spark, messy, no_docs, reference_tokens):
    rows = p.pack(messy).collect()
    assert sum(r["start"] == 0 for r in rows) == messy.count()
    whole = {r["doc_id"]: r["text"] for r in messy.collect() if r["doc_id"] not in (1, None)}
    check_rows(rows, whole, reference_tokens, 1024)
    assert p.pack(no_docs).count() == 0


def test_added_token_inside_text_is_one_id_as_in_the_tokenizers_file(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))  # its default flags
    encoder = p.load_encoder(p.default_vocabulary())
    assert p.token_ids(encoder, "a <|endoftext|> b") == [64, 220, 50256, 275]
    parts = ["<|endoftext|>", "<|endoftext|>" * 3, "<|endof", "text|>", " ", "  \n ", "it's", "\u6f22\u5b57", "<|", "\U0001f600 x"]
    texts = ["".join(np.random.default_rng(i).choice(parts, 8)) for i in range(200)] + ["", *parts]
    for text in texts:
        assert p.token_ids(encoder, text) == t.encode(text, add_special_tokens=False).ids
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check_rows(p.pack(docs, capacity=16).collect(), dict(enumerate(texts)),
               lambda text: [*t.encode(text, add_special_tokens=False).ids, 2], 16)


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 2_000_000, "\t" * 2_000_000, " \n\t" * 400_000,
                                  "a" + " " * 1_500_000 + "b c", "x" * 300_000, "\u6f22\u5b57" * 50_000,
                                  ("word " * 900 + " " * 3_000 + "<|endoftext|>") * 3])
def test_long_runs_have_the_ids_of_the_tokenizers_file(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = p.load_encoder(p.default_vocabulary())
    assert p.token_ids(encoder, text) == t.encode(text, add_special_tokens=False).ids


def test_a_document_of_blanks_is_packed(spark):
    docs = spark.createDataFrame([(1, " " * 1_200_000), (2, "a b"), (3, "\n" * 1_200_000)], "doc_id long, text string")
    rows = p.pack(docs).groupBy("doc_id").agg({"length": "sum"}).collect()
    assert {r[0]: r[1] for r in rows} == {1: 1_200_001, 2: 3, 3: 600_001}
