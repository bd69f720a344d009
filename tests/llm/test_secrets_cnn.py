import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from cloudmarts.llm import secrets_cnn as x

PARTS = st.sampled_from(["password", "PassWD", "secret", "tok\u212aen", "token", "api_key", "apikey", ":", "=", " ", '"', "'",
                         "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef", "deadbeef", "é", "\n", "ab", "A1", "+/"])


def brute(text):
    out = []
    assign = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for k, kind, p, ok in ((0, "assign", assign, lambda m: len(m.group(2)) >= 6),
                           (1, "access", "AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 20),
                           (2, "hex", "[0-9a-f]+", lambda m: len(m.group()) >= 24)):
        out += [(m.start(), k, m.end(), kind) for m in re.finditer(p, text) if ok(m)]
    return [(a, b, kind) for a, _, b, kind in sorted(out)]


@settings(max_examples=400, deadline=None)
@given(st.lists(PARTS, max_size=14).map("".join))
def test_base_spans_are_the_three_patterns(text):
    assert x.base_spans(text) == brute(text)


def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def test_query_columns_by_brute_force(spark):
    docs = documents(spark)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in x.scan_secrets(docs).collect():
        want = brute(texts[r["doc_id"]])
        line = ",".join(f"{k}:{a}:{b}" for a, b, k in want)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert set(filter(None, line.split(","))) <= set(r["spans"].split(","))
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == kind for _, _, k in want) for kind in x.KINDS)


def test_the_network_recalls_held_back_findings_and_spares_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 4000")
    net = x.train(docs)
    fresh = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id >= 7000").collect()]
    hits = words = found = spared = 0
    for text in fresh:
        base = x.base_spans(text)
        for a, b in x.candidates(text):
            sure = net.probability([x.window(text, a, b)])[0] >= net.thresholds[x.shape(text[a:b])]
            if any(s < b and a < e for s, e, _ in base):
                hits, found = hits + 1, found + sure
            else:
                words, spared = words + 1, spared + (not sure)
    assert found >= 0.9 * hits and spared >= 0.995 * words
    secret = "here is 9f86d081884c7d659a2feaa0c55ad015a3bf4f1b now".upper()
    assert x.base_spans(secret) == [] and not x.all_spans(["plain words, nothing hidden"], net)[0]


def test_redaction_and_messy_rows(spark, messy, no_docs):
    docs = spark.createDataFrame([(1, 'a token = "abcdef123456789" b', 29), (2, None, None), (3, "clean", 5)],
                                 "doc_id long, text string, n_chars int")
    out = {r["doc_id"]: r for r in x.redact(docs).collect()}
    assert out[1]["text"] == 'a [SECRET]" b' and out[1]["n_chars"] == len(out[1]["text"])
    assert out[2]["text"] is None and out[2]["n_chars"] is None and out[3]["text"] == "clean"
    assert x.redact(messy).columns == messy.columns and x.redact(messy).count() == messy.count()
    assert x.redact(messy).schema == messy.schema or [f.dataType for f in x.redact(messy).schema] == [f.dataType for f in messy.schema]
    assert x.scan_secrets(messy).count() == messy.count() and x.scan_secrets(no_docs).count() == 0


class UpperNet:
    """Stands for the network: sure of windows with a run of ten Z inside the candidate."""
    thresholds = dict.fromkeys(x.CLASSES, 0.5)

    def probability(self, windows):
        return [float(bytes([ord("Z") - 32 + 98]) * 10 in w) for w in windows]


def test_a_long_candidate_is_read_to_its_end():
    for at in (0, 40, 47, 60, 333, 990):
        run = "p" * at + "Z" * 10 + "q" * (1000 - at - 10)
        assert x.all_spans(["see " + run + " end", "x " + "p" * 1000], UpperNet()) == [[(4, 1004, "cnn")], []]
    parts = x.slices(5, 1005)
    assert parts[0][0] == 5 and parts[-1][1] == 1005 and all(b - a == x.INSIDE for a, b in parts)
    assert all(c <= b - x.STRIDE for (_, b), (c, _) in zip(parts, parts[1:], strict=False))


def test_what_a_base_finding_leaves_of_a_candidate_is_judged_on_its_own():
    hidden, found = "Z" * 10 + "q" * 10, "0123456789abcdef" * 2
    text = f"{hidden}/{found}Y{hidden} and Zz{found}"
    spans, = x.all_spans([text], UpperNet())
    assert spans == [(0, 21, "cnn"), (21, 53, "hex"), (53, 74, "cnn"), (81, 113, "hex")]
    assert x.clear_parts("ab" + found, x.base_spans("ab" + found)) == []


def test_a_rare_positive_is_learned_from_wherever_it_lies(spark):
    rows = [(i, f"a plain word{i} and/some/longer/path/number{i} here") for i in range(400)]
    rows += [(1000 + i, f'x token = "{hashlib.sha1(bytes([i])).hexdigest()}" y') for i in range(2)]
    net = x.train(spark.createDataFrame(rows, "doc_id long, text string"), sample_docs=4)
    assert net is not None and x.fit([b"a" * x._WIDTH], [b"b" * x._WIDTH]) is not None


def test_thresholds_recall_what_they_promise():
    rng = __import__("random").Random(3)
    texts = ["".join(rng.choices("0123456789abcdef", k=24)) for _ in range(600)]
    windows = [x.window(t, 0, 24) for t in texts]  # both labels look alike: no score is above a half for all
    net = x.fit(windows[:100], windows[100:])
    _, kept = x._split(windows[:100])
    assert net.thresholds["hex"] < 0.5
    assert (net.probability(kept) >= net.thresholds["hex"]).mean() >= x.RECALL


def test_every_window_is_learned_from_however_many(spark, monkeypatch):
    rows = [(i, f"a plain word{i} and/some/longer/path/number{i} here") for i in range(400)]
    rows += [(1000 + i, f'x token = "{hashlib.sha1(bytes([i])).hexdigest()}" y') for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    monkeypatch.setattr(x, "_fit_blocks", lambda many, n, few: seen.append((many.count(), n, {k: len(v) for k, v in few.items()})))
    monkeypatch.setattr(x, "FEW", 50)
    x.train(docs)
    monkeypatch.setattr(x, "FEW", 10)
    x.train(docs)
    assert seen == [(400, 400, {True: 40}), (440, 440, {})]


def test_blocks_learn_what_one_block_learns(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    fresh = [r["text"] for r in docs.where("doc_id >= 7000").collect()]
    for few in (500, 50):  # the labelled findings beside every block, then dealt to the blocks too
        monkeypatch.setattr(x, "FEW", few)
        monkeypatch.setattr(x, "BLOCK", 300)
        net = x.train(docs.where("doc_id < 7000"))
        asked = [(any(s < b and a < e for s, e, _ in x.base_spans(t)), x.window(t, a, b), x.shape(t[a:b]))
                 for t in fresh for a, b in x.candidates(t)]
        sure = [p >= net.thresholds[c] for p, (_, _, c) in zip(net.probability([w for _, w, _ in asked]), asked, strict=True)]
        found = [s for s, (label, _, _) in zip(sure, asked, strict=True) if label]
        words = [s for s, (label, _, _) in zip(sure, asked, strict=True) if not label]
        assert sum(found) >= 0.9 * len(found) and sum(words) <= 0.005 * len(words)
