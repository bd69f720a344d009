import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cloudmarts.llm import pii_crf as c

PARTS = st.sampled_from(["a", ".", "b.c", "@", "%", "-", "1", "25", "256", "4111 1111 1111 1111", "4111-1111-1111-1111", "+", "+1 (234) 555-",
                         "0199", " ", "(", ")", "é", "٣", "00000000", "10.0.0.1", "\n", "x@y.z", "_"])


def brute(text):
    out = []
    for k, (kind, p) in enumerate((
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))):
        for m in re.finditer(p, text):
            digits = [int(d) for d in re.sub("[^0-9]", "", m.group())]
            luhn = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(digits))) % 10 == 0
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                    "card": 12 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((m.start(), k, m.end(), kind))
    return [(a, b, kind) for a, _, b, kind in sorted(out)]


@settings(max_examples=600, deadline=None)
@given(st.lists(PARTS, max_size=14).map("".join))
def test_base_spans_are_the_four_patterns(text):
    assert c.base_spans(text) == brute(text)


def test_long_runs_take_linear_time():
    for run in ("a" * 300_000, "1" * 300_000, "a." * 150_000, "1." * 150_000, "+1" * 100_000, "@" * 200_000):
        c.base_spans(run)
        c.nodes(run)


def test_skip_edges_join_repeats_and_shapes():
    same, alike = c.skips(["555-0199", "x1", "555-0199,", "444-0123"])
    assert same == [(0, 2)] and alike == [(2, 3)]


def test_message_passing_is_exact_on_a_tree():
    rng = np.random.default_rng(2)
    model = c.SkipChainCrf(np.zeros((1, 5)), rng.standard_normal((3, 5, 5)))
    unary = rng.standard_normal((3, 5))
    got = model.posterior(unary, np.array([[0, 1], [1, 2]]), np.array([0, 2]), rounds=60)
    joint = (unary[0][:, None, None] + unary[1][None, :, None] + unary[2][None, None, :]
             + model.edges[0][:, :, None] + model.edges[2][None, :, :])
    p = np.exp(joint) / np.exp(joint).sum()
    want = [p.sum((1, 2)), p.sum((0, 2)), p.sum((0, 1))]
    assert np.allclose(got, want, atol=1e-6)


def test_query_columns_by_brute_force_and_label_consistency(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 3000")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    model = c.train(docs)
    added = 0
    for r in c.find_pii(docs, model).collect():
        want = brute(texts[r["doc_id"]])
        line = ",".join(f"{k}:{a}:{b}" for a, b, k in want)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert set(filter(None, line.split(","))) <= set(r["spans"].split(","))
        added += r["n_crf"]
    assert added < 60  # clean numbers stay clean
    text = "call +1 (543) 555-3833 or 555-3833 today, again 555-3833"
    assert {k for _, _, k in model.spans([text])[0]} >= {"phone", "phone_crf"}


def test_messy_rows(messy, no_docs):
    rows = c.scan_pii(messy).collect()
    assert len(rows) == messy.count()
    empty = hashlib.sha256(b"").hexdigest()
    assert all(r["base_sha256"] == empty and r["spans"] == "" for r in rows if r["doc_id"] in (2, 3, 4))
    assert c.scan_pii(no_docs).count() == 0


def test_evidence_crosses_a_whole_chain_of_repeats():
    n = 400
    table = np.where(np.eye(5) > 0, 3.0, -3.0)
    model = c.SkipChainCrf(np.zeros((1, 5)), np.array([table] * 3))
    unary = np.zeros((n, 5))
    unary[:, 0] = 1e-3
    unary[0] = -50.0
    unary[0, 4] = 0.0
    ends = np.array([[i, i + 1] for i in range(n - 1)])
    got = model.posterior(unary, ends, np.ones(n - 1, dtype=np.int64))
    ahead, behind = [unary[0]], [np.zeros(5)]
    for i in range(1, n):  # exact: forward and backward along the chain
        ahead.append(unary[i] + np.log(np.exp(ahead[-1][:, None] + table).sum(0)) - 3)
        behind.append(np.log(np.exp(table + (unary[n - i] + behind[-1])[None, :]).sum(1)) - 3)
    want = np.array(ahead) + np.array(behind[::-1])
    want = np.exp(want - want.max(axis=1, keepdims=True))
    want /= want.sum(axis=1, keepdims=True)
    assert np.allclose(got, want, atol=1e-6) and got[30, 4] > 0.6


def test_messages_settle_on_loops_alone_or_among_other_documents():
    rng = np.random.default_rng(4)
    model = c.SkipChainCrf(np.zeros((1, 5)), np.clip(rng.standard_normal((3, 5, 5)) + 2 * np.eye(5), -3, 3))
    ends = np.array([[i, j] for i in range(12) for j in (i + 1, i + 4) if j < 12])
    kinds = np.arange(len(ends)) % 3
    unary = rng.standard_normal((32, 5))
    both = model.posterior(unary, np.concatenate([ends, [[i, i + 1] for i in range(12, 31)]]), np.concatenate([kinds, np.ones(19, dtype=np.int64)]))
    assert np.allclose(both[:12], model.posterior(unary[:12], ends, kinds), atol=1e-9)
    assert np.allclose(both[:12], model.posterior(unary[:12], ends, kinds, rounds=1000), atol=1e-4)


def test_features_see_a_whole_token():
    token = "a" * 70
    plain, late = c.node_features(token + "1", 0, 71), c.node_features(token + "1@b.c", 0, 75)
    assert plain[4] != late[4] and plain[2] != c.node_features(token + "123", 0, 73)[2]


def test_neighbours_are_read_whole():
    from cloudmarts.llm.pii_crf import _word

    long = "Abc" * 5_000
    text = f"{long}{' ' * 70}42 \n\t{long} end"
    at = text.index("42")
    assert _word(text, at, -1) == _word(text, at + 2, 1) == long.lower()
    assert _word("7", 0, -1) == _word("7", 1, 1) == "" and _word("   7   ", 3, -1) == _word("   7   ", 4, 1) == ""
    assert _word("one two 7", 8, -1) == "two" and _word("7 one two", 1, 1) == "one"
