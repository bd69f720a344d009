import re

from cloudmarts.llm import url_rules as u

URLS = ["http://A.Example.com/en/1?x=/fr/", "https://www.example.com/en/", "https://x.www.example.com/en/p#f", "http://example.com/fr/",
        "http://notexample.com/en/", "http://m.net/es/1", "http://net/fr/", "http://m.net/esp/", "http://com", "http://com/", "no scheme",
        None, "", "://", "http://", "ftp://spam-farm.example.org/en/1", "http://spamfarm.example.org/", "http://org/spam/", "http://b.casino.org",
        "http://h.net:80/es/", "http://x.org/a://b.com/en/", "http://ÉCOLE.com/É", "HTTP://POKER.ORG/x", "http://a.org?u=http://x.com/",
        "http://x.net/FR/", "http://x.net/fr/" + "a" * 100_000]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = "".join(c.lower() if c.isascii() else c for c in host)
    best = None
    for verdict, rule in (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
                          ("block", "net/es/"), ("block", "net/fr/")):
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[1])):
            best = (verdict, rule)
    if best:
        return host, path, best[1], best[0]
    bad = bool(set(re.split(r"[.-]", host)) & set(u.UNWANTED_WORDS))
    return host, path, None, "block" if bad else "allow"


def test_by_trying_every_rule(spark):
    pages = spark.createDataFrame([(i, x, "html", "mine", "mine") for i, x in enumerate(URLS)],
                                  "page_id long, url string, html string, rule string, host string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in u.judge(pages).collect()}
    assert got == {i: brute(x) for i, x in enumerate(URLS)}


def test_whole_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    want = {r["page_id"]: brute(r["url"]) for r in pages.collect()}
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in u.judge(pages).collect()} == want


def test_rules_are_filed_under_their_rarest_token(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    urls = pages.select(*[c.alias(n) for c, n in zip(u.host_and_path("url"), ("host", "path"), strict=True)])
    counts = u.token_counts(urls, u.RULES)
    index = u.token_index(u.RULES, counts)
    assert sorted(r.name for found in index.values() for r in found) == sorted(r.name for r in u.RULES)
    assert all(counts[t] == min(counts[x] for x in r.tokens) for t, found in index.items() for r in found)
    assert counts["com"] > counts["casino"]


def test_ties_repeats_and_empty_tables(spark):
    both = (u.Rule("ab", "x", ("x",), "allow"), u.Rule("cd", "x", ("x",), "block"), u.Rule("any", "y", (), "block"))
    pages = spark.createDataFrame([(1, "http://x/"), (1, "http://x/"), (None, "http://zyz/")], "page_id long, url string")
    assert [r["verdict"] for r in u.judge(pages, both).collect()] == ["block"] * 3
    assert u.judge(pages.limit(0)).count() == 0
    assert {r["verdict"] for r in u.judge(pages, ()).collect()} == {"allow"}
