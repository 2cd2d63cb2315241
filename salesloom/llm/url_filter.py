"""URL filters: site and pattern rules, looked up by their rarest literal token.

Method: each rule is indexed by the one of its literal tokens that is rarest in the URLs at hand; a URL's
tokens fetch the rules indexed by them, and only those run their regular expressions. A rule without a
token is fetched by every URL. All steps are DataFrame operations.

A site rule ``host/path`` fits its host and all subdomains if the URL's path starts with the rule's path.
The longest fitting site rule decides; without one a fitting pattern rule does (the longest pattern), and
without any rule the URL is allowed.

Scale: only distinct URLs are judged, so a URL on a third of all pages is judged once; the rules are a list
of the caller's and travel as a local table whose size Spark knows. The one wide step is the join of verdicts
to pages by URL, in which adaptive execution splits a hot URL.

Defined cases: null URLs and those without ``://`` have empty host and path and fit no site rule; repeated
rows are judged alike; extra columns pass through, except those named like the result's own, which are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.frames import without

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = "[^0-9a-z]+"


class SiteRule(NamedTuple):
    verdict: str
    rule: str  # host, then the path from its first slash on


class PatternRule(NamedTuple):
    verdict: str
    regex: str  # searched in the lower-cased URL
    tokens: tuple[str, ...] = ()  # whole a-z0-9 runs that any match contains


SITE_RULES = (
    SiteRule("allow", "com/"),
    SiteRule("block", "example.com/en/"),
    SiteRule("allow", "www.example.com/en/"),
    SiteRule("block", "net/es/"),
    SiteRule("block", "net/fr/"),
)
PATTERN_RULES = (
    PatternRule("block", r"[/.]login([/?#.]|$)", ("login",)),
    PatternRule("block", r"[/.]cart([/?#.]|$)", ("cart",)),
    PatternRule("block", r"[?&]sessionid=", ("sessionid",)),
    PatternRule("block", r"[?&](ad|click|track)_?id="),
)


def host_and_path(url: str | Column) -> tuple[Column, Column]:
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, shape, 1), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, shape, 2), F.lit(""))


def _site_tokens(rule: str) -> set[str]:
    """Tokens that every URL under the rule has whole: of a path's last part only if a slash ends it."""
    whole = rule[: rule.rindex("/") + 1]
    return {t for t in re.split(_TOKEN, whole.lower()) if t}


def _rows(sites: Sequence[SiteRule], patterns: Sequence[PatternRule]) -> list[tuple]:
    rows = []
    for verdict, rule in sites:
        regex = rf"^(?:[^/]*\.)?{re.escape(rule)}"
        rows.append((0, -len(rule), rule, regex, verdict, _site_tokens(rule)))
    for verdict, regex, tokens in patterns:
        rows.append((1, -len(regex), None, regex, verdict, set(tokens)))
    return rows


def judge_urls(pages: DataFrame, sites: Sequence[SiteRule] = SITE_RULES, patterns: Sequence[PatternRule] = PATTERN_RULES, url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (the site rule that decided, else null) and ``verdict``."""
    spark = pages.sparkSession
    pages = without(pages, "host", "path", "rule", "verdict")
    host, path = host_and_path("_url")
    urls = pages.select(F.col(url).alias("_url")).where(F.col("_url").isNotNull()).distinct()
    urls = urls.select("_url", F.concat(host, path).alias("place"), F.lower("_url").alias("whole"))
    tokens = F.array_distinct(F.split(F.lower("_url"), _TOKEN))
    fetched = urls.select("*", F.explode(F.concat(F.filter(tokens, lambda t: t != ""), F.array(F.lit("")))).alias("token"))

    rows = _rows(sites, patterns)
    literals = sorted(set().union(*[r[5] for r in rows])) or [""]
    asked = spark.createDataFrame([(t,) for t in literals], "token string")
    seen = {r.token: r.n for r in fetched.join(asked, "token").groupBy("token").agg(F.count("*").alias("n")).collect()}  # a row per rule token
    index = [(*r[:5], min(r[5], key=lambda t: (seen.get(t, 0), t), default="")) for r in rows]
    rules = spark.createDataFrame(index, "kind int, rank int, rule string, regex string, verdict string, token string")

    fits = F.when(F.col("kind") == 0, F.regexp_like("place", F.col("regex"))).otherwise(F.regexp_like("whole", F.col("regex")))
    first = F.min(F.struct("kind", "rank", "rule", "regex", "verdict")).alias("first")
    judged = fetched.join(rules, "token").where(fits).groupBy("_url").agg(first)
    host, path = host_and_path(url)
    found = judged["first"]
    # By reference: a table may have columns of these names too.
    return pages.join(judged, pages[f"`{url}`"] == judged["_url"], "left").select(
        *[pages[f"`{c}`"] for c in pages.columns],
        host.alias("host"),
        path.alias("path"),
        found["rule"].alias("rule"),
        F.coalesce(found["verdict"], F.lit("allow")).alias("verdict"),
    )
