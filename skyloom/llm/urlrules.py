"""URL filters: rules indexed by their rarest literal token.

Every rule has a regular expression over `host + path + query` and literal tokens ([a-z0-9]+) that any URL it fits must
hold. One aggregation counts these tokens over all URLs; the rarest stands for the rule in the index. A URL's tokens
fetch candidate rules, and only their expressions run. Site rules (a host with all subdomains, and a path prefix) come
first, the longest of those that fit (of equal names the first given); then block patterns, the first by name; else the URL is allowed. A rule without a literal token is a candidate for every URL.

Rules go to the tasks AT_ONCE at a time: a longer list takes a written pass for each part, which carries the best rule so far along. Null URLs and
those without `://` have an empty host and path and are allowed. Nothing is shuffled but the token counts. Very long URLs are taken whole; repeated rows are judged
each for itself; an empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import written

AT_ONCE = 100_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = re.compile("[a-z0-9]+")


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    site: bool = True


def site_rule(host: str, path: str, verdict: str) -> Rule:
    """A host, its subdomains, and a path prefix. Of the path only tokens that a separator ends are sure to be whole."""
    whole = re.findall(r"[a-z0-9]+(?=[^a-z0-9])", path)
    return Rule(host + path, verdict, rf"^(?:[^/?#]*\.)?{re.escape(host)}{re.escape(path)}", (*_TOKEN.findall(host), *whole))


def block_pattern(name: str, pattern: str, *tokens: str) -> Rule:
    return Rule(name, "block", pattern, tokens, site=False)


# What no site rule decides is blocked if it is a session, a cart or an installer.
PATTERNS = [
    block_pattern("session", r"[?&]sessionid=", "sessionid"),
    block_pattern("login", r"/login(?:[/?#]|$)", "login"),
    block_pattern("cart", r"/cart(?:[/?#]|$)", "cart"),
    block_pattern("installer", r"\.exe(?:[?#]|$)", "exe"),
]


def parts(url: Column) -> dict[str, Column]:
    """host (A-Z lower-cased), path, and the rest from `?` or `#` on."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return {"host": F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), "rest": F.regexp_extract(rest, "(?s)^[^?#]*(.*)", 1)}


def rarest_index(urls: DataFrame, rules: Iterable[Rule]) -> dict[str | None, list[Rule]]:
    """The rules by the literal token that the fewest URLs hold; under None those that have none. urls(url_text); only rule tokens are counted."""
    rules = list(rules)
    names = sorted({t for r in rules for t in r.tokens})
    known = urls.sparkSession.createDataFrame([(t,) for t in names], "token string")
    tokens = urls.select(F.explode(F.array_distinct(F.split(F.lower("url_text"), "[^a-z0-9]+"))).alias("token"))
    counts = dict(tokens.join(F.broadcast(known), "token").groupBy("token").count().collect())
    index: dict[str | None, list[Rule]] = {}
    for r in rules:
        index.setdefault(min(r.tokens, key=lambda t: (counts.get(t, 0), t)) if r.tokens else None, []).append(r)
    return index


def _decide(index: dict[str | None, list[Rule]]):
    """Site rule, its verdict and block pattern, from these rules and the best of the rules before."""

    @F.pandas_udf("rule string, ruled string, pattern string")
    def decide(frames: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        compiled: dict[str, re.Pattern] = {}

        def fits(rule: Rule, text: str) -> bool:
            if (pattern := compiled.get(rule.pattern)) is None:
                pattern = compiled[rule.pattern] = re.compile(rule.pattern)
            return pattern.search(text) is not None

        for columns in frames:
            rows = []
            for text, name, ruled, block in zip(*columns, strict=True):
                site = (name, ruled)
                for token in (None, *set(_TOKEN.findall(text.lower()))):
                    for r in index.get(token, ()):
                        if r.site and (site[0] is None or (len(r.name), r.name) > (len(site[0]), site[0])) and fits(r, text):
                            site = (r.name, r.verdict)
                        elif not r.site and (block is None or r.name < block) and fits(r, text):
                            block = r.name
                rows.append((*site, block))
            yield pd.DataFrame(rows, columns=["rule", "ruled", "pattern"], dtype=object)

    return decide


def judge(pages: DataFrame, rules: Iterable[Rule], key: str = "page_id", url: str = "url") -> DataFrame:
    """Returns the key, host, path, rule (of the site rule that decided, else null), pattern (of the block pattern, else null), verdict."""
    cut = pages.select(F.col(key), F.col(url).alias("url")).withColumns(parts(F.col("url").cast("string"))).withColumn("url_text", F.concat("host", "path", "rest"))
    rules, none = list(rules), F.lit(None).cast("string")
    rows = cut.select(key, "host", "path", "url_text", none.alias("rule"), none.alias("ruled"), none.alias("pattern"))
    for at in range(0, len(rules), AT_ONCE):
        index = rarest_index(cut.select("url_text"), rules[at : at + AT_ONCE])
        rows = rows.withColumn("judged", _decide(index)("url_text", "rule", "ruled", "pattern")).select(key, "host", "path", "url_text", "judged.*")
        if len(rules) > AT_ONCE:
            rows = written(rows)
    blocked = F.when(F.col("rule").isNotNull(), F.col("ruled")).when(F.col("pattern").isNotNull(), "block").otherwise("allow")
    return rows.select(key, "host", "path", "rule", F.when(F.col("rule").isNull(), F.col("pattern")).alias("pattern"), blocked.alias("verdict"))
