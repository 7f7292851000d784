"""URL filters (10): pattern rules found by their rarest literal token.

A rule is a host and a path prefix (``example.com/en/``) or a regular
expression over host and path, with a verdict. Every rule has literal
tokens; how often each occurs in all URLs is counted by Spark (only tokens
that rules name, so the counts are as many as the rules' tokens), and the
rule is filed under its rarest one. A URL's own tokens fetch candidate
rules, and only those run their regular expression. The index is bounded by
the rules and travels to the tasks; URLs are judged in one narrow pass.

Which rule wins: host/path rules before expressions, longer ones first.
Without a rule of either kind the verdict is allow.

Rules are a list, or a table of up to ``MAX_RULES`` rows (:func:`rules_from_table`); a
longer one is refused, as every worker holds the index.

Defined cases: a null URL or one without ``://`` has an empty host and path
and is allowed; very long URLs are matched whole; of rules that fit, a host/path
rule goes before a pattern, then the longest, then the last in order; null ids,
repeated rows and empty tables go row by row; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.llm.common import map_batches, spread

TOKEN = r"[a-z0-9]+"
_token = re.compile(TOKEN)
MAX_RULES = 200_000


@dataclass(frozen=True)
class UrlRule:
    """``text`` is what reports show; ``pattern`` runs over host + path;
    ``literals`` are tokens that every URL that fits must have."""

    text: str
    verdict: str
    pattern: str
    literals: tuple[str, ...]
    rank: int = 0               # 1: host/path rule, beats expressions


def host_path_rule(verdict: str, host: str, path: str = "/") -> UrlRule:
    """Fits ``host`` and its subdomains if the path starts with ``path``."""
    closed = path if _token.fullmatch(path[-1:].lower()) is None else path.rpartition("/")[0]
    return UrlRule(host + path, verdict, r"^(?:[^/]*\.)?" + re.escape(host) + re.escape(path),
                   tuple(dict.fromkeys(_token.findall(f"{host}/{closed}".lower()))), 1)


def word_rule(verdict: str, words: str) -> UrlRule:
    """Fits URLs whose host or path has the hyphenated words as whole tokens."""
    return UrlRule(words, verdict, r"(?:^|[^a-z0-9])" + re.escape(words) + r"(?![a-z0-9])", tuple(_token.findall(words)))


# fixed values: the host/path rules of the registered query
HOST_RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
              ("block", "net", "/es/"), ("block", "net", "/fr/")]
# fixed values: words of spam hosts and paths
SPAM_WORDS = ["free-bets", "cheap-pills", "online-casino", "adult-cams", "payday-loans", "hot-singles",
              "fake-watches", "win-prizes", "casino", "porn", "xxx", "viagra", "poker"]


def default_rules() -> list[UrlRule]:
    return [host_path_rule(*r) for r in HOST_RULES] + [word_rule("block", w) for w in SPAM_WORDS]


def rules_from_table(rules: DataFrame) -> list[UrlRule]:
    """Rules of a table ``(verdict, host, path, words)``: host and path rules have a host,
    pattern rules have words."""
    rows = rules.select("verdict", "host", "path", "words").limit(MAX_RULES + 1).collect()
    if len(rows) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    return [host_path_rule(r["verdict"], r["host"], r["path"] or "") if r["host"] is not None
            else word_rule(r["verdict"], r["words"]) for r in rows]


def rule_index(rules: list[UrlRule], counts: dict[str, int]) -> dict[str, list[UrlRule]]:
    """Every rule filed under its rarest token."""
    index: dict[str, list[UrlRule]] = defaultdict(list)
    for r in rules:                               # a rule without a token is tried on every URL
        index[min(r.literals, key=lambda t: (counts.get(t, 0), t), default="")].append(r)
    return dict(index)


def candidates(index: dict, host: str, path: str) -> Iterator:
    """What is filed under the tokens of a URL."""
    for t in ("", *dict.fromkeys(_token.findall((host + path).lower()))):
        yield from index.get(t, ())


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
                       "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return host, path


def token_counts(parts: DataFrame, wanted: list[str]) -> dict[str, int]:
    """Occurrences of the rules' own tokens over all URLs (one row each)."""
    words = parts.select(F.explode(F.regexp_extract_all(F.lower(F.concat("host", "path")), F.lit(TOKEN), F.lit(0)))
                         .alias("token"))
    rows = words.filter(F.col("token").isin(wanted)).groupBy("token").agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["token"]: r["n"] for r in rows}


def judge_urls(pages: DataFrame, rules: list[UrlRule] | None = None, id_col: str = "page_id",
               url_col: str = "url") -> DataFrame:
    """``(page_id, host, path, rule, verdict, pattern)`` per row: ``rule`` is the host/path
    rule that won (null if none), ``pattern`` the expression that decided otherwise."""
    rules = default_rules() if rules is None else rules
    host, path = url_parts(F.col(url_col))
    parts = pages.select(F.col(id_col).cast("bigint").alias("page_id"), host.alias("host"), path.alias("path"))
    counts = token_counts(parts, sorted({t for r in rules for t in r.literals}))
    bc = pages.sparkSession.sparkContext.broadcast(rule_index(rules, counts))

    def run(b: pa.RecordBatch) -> dict:
        by_token = {t: [(r, re.compile(r.pattern)) for r in rs] for t, rs in bc.value.items()}
        found: dict[str, list] = {"rule": [], "verdict": [], "pattern": []}
        for h, p in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            best = None
            for r, expression in candidates(by_token, h, p):
                where = h + p if r.rank else (h + p).lower()
                if (best is None or (r.rank, len(r.text), r.text) > (best.rank, len(best.text), best.text)) \
                        and expression.search(where):
                    best = r
            found["rule"].append(best.text if best and best.rank else None)
            found["verdict"].append(best.verdict if best else "allow")
            found["pattern"].append(best.text if best and not best.rank else None)
        return {"page_id": b.column(0), "host": b.column(1), "path": b.column(2)} | {
            k: pa.array(v, pa.string()) for k, v in found.items()}

    return map_batches(spread(parts), run,
                       "page_id bigint, host string, path string, rule string, verdict string, pattern string")
