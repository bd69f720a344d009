"""URL filters: pattern rules indexed by their rarest literal token.

Every rule is a regular expression over ``host + path`` with the literal tokens (runs of
letters and digits) that any matching url must contain whole.  The tokens' frequencies are
counted over all urls; each rule is filed under its rarest one.  A url's tokens fetch the
candidate rules, and only those run their expression.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TOKEN = r"[A-Za-z0-9]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    name: str
    pattern: str
    tokens: tuple[str, ...]   # empty: every url is a candidate
    verdict: str              # allow or block
    tier: int = 1             # 0 before 1; then the longest name, then block


def host_path_rule(verdict: str, rule: str) -> Rule:
    """``host/path``: the host and all its subdomains, paths that start with /path."""
    host, _, rest = rule.partition("/")
    path = "/" + rest
    whole = re.findall(_TOKEN, path if path.endswith("/") else path.rpartition("/")[0] + "/")
    return Rule(rule, rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape(path)}",
                tuple(re.findall(_TOKEN, host) + whole), verdict, 0)


def host_word_rule(word: str) -> Rule:
    """Block hosts that have the word between dots or hyphens."""
    return Rule(word, rf"^(?:[^/]*[.-])?{re.escape(word)}(?:[.-][^/]*)?(?:/|$)", (word,), "block")


#: The host rules, then words that mark a host as unwanted.
HOST_RULES = (host_path_rule("allow", "com/"), host_path_rule("block", "example.com/en/"),
              host_path_rule("allow", "www.example.com/en/"), host_path_rule("block", "net/es/"),
              host_path_rule("block", "net/fr/"))
UNWANTED_WORDS = ("adult", "betting", "casino", "clickbait", "lottery", "pills", "poker", "porn",
                  "spam", "torrent", "viagra", "warez", "xxx")
RULES = (*HOST_RULES, *(host_word_rule(w) for w in UNWANTED_WORDS))


def host_and_path(url: str) -> tuple[Column, Column]:
    """Of a url column; null, or no ``://``: both empty."""
    rest = F.when(F.instr(F.col(url), "://") > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)"))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), UPPER, LOWER), F.coalesce(path, F.lit(""))


def token_counts(urls: DataFrame, rules: tuple[Rule, ...]) -> dict[str, int]:
    """How many urls hold each literal token of the rules (as many rows as such tokens)."""
    wanted = sorted({t for r in rules for t in r.tokens})
    found = (urls.select(F.explode(F.array_intersect(
        F.regexp_extract_all(F.concat("host", "path"), F.lit(f"({_TOKEN})"), 1),
        F.array(*[F.lit(t) for t in wanted]).cast("array<string>"))).alias("token"))
        .groupBy("token").count())
    counts = dict.fromkeys(wanted, 0)
    counts.update({r["token"]: r["count"] for r in found.collect()})
    return counts


def token_index(rules: tuple[Rule, ...], counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Rarest token -> rules; rules without one are filed under the empty string."""
    index: dict[str, list[Rule]] = defaultdict(list)
    for rule in rules:
        index[min(rule.tokens, key=lambda t: (counts[t], t), default="")].append(rule)
    return dict(index)


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per page row: page_id, host, path, rule (the host rule that won, else null),
    pattern (the other rule that won, else null), verdict (allow if no rule fits).

    The lowest tier wins, then the longest name, then block before allow.  Null urls and urls
    without ``://`` have empty host and path and fit no rule; repeated rows are judged each;
    an empty table gives an empty result; other columns are not read.
    """
    host, path = host_and_path("_url")
    urls = pages.select("page_id", F.col("url").cast("string").alias("_url")).select(
        "page_id", host.alias("host"), path.alias("path"))
    index = {t: [astuple(r) for r in found]
             for t, found in token_index(rules, token_counts(urls, rules)).items()}

    @F.pandas_udf("rule string, pattern string, verdict string")
    def decide(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        ready = {t: [(re.compile(r.pattern), r) for r in (Rule(*x) for x in found)] for t, found in index.items()}
        split = re.compile(_TOKEN)
        for urls in batches:
            rows = []
            for url in urls:
                best = None
                for token in {"", *split.findall(url)}:
                    for pattern, rule in ready.get(token, ()):
                        rank = (rule.tier, -len(rule.name), rule.verdict != "block", rule.name)
                        if (best is None or rank < best[0]) and pattern.search(url):
                            best = (rank, rule)
                rule = best[1] if best else None
                rows.append((rule.name if rule and rule.tier == 0 else None,
                             rule.name if rule and rule.tier else None, rule.verdict if rule else "allow"))
            yield pd.DataFrame(rows, columns=["rule", "pattern", "verdict"])

    judged = urls.withColumn("d", decide(F.concat("host", "path")))
    return judged.select("page_id", "host", "path", "d.rule", "d.pattern", "d.verdict")


def _sql_verdict() -> str:
    words = "|".join(UNWANTED_WORDS)
    return rf"CASE WHEN regexp_matches(host || path, '^([^/]*[.-])?({words})([.-][^/]*)?(/|$)') THEN 'block' ELSE 'allow' END"


def _sql_fits(rule: Rule) -> str:
    host, _, rest = rule.name.partition("/")
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{rest}'))"


def oracle_sql() -> str:
    ordered = sorted(HOST_RULES, key=lambda r: -len(r.name))
    rule = " ".join(f"WHEN {_sql_fits(r)} THEN '{r.name}'" for r in ordered)
    verdict = " ".join(f"WHEN {_sql_fits(r)} THEN '{r.verdict}'" for r in ordered)
    return rf"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut),
ruled AS (SELECT *, CASE {rule} END AS rule FROM parts)
SELECT page_id, host, path, rule,
       CASE {verdict} ELSE {_sql_verdict()} END AS verdict
FROM ruled"""
