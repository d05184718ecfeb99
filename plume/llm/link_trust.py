"""URL filter by link-graph propagation, in DataFrame functions only.

Rules judge the addresses they fit. For the others the verdict is that of
their host: trust flows from the hosts of allowed pages along links
(personalised PageRank), distrust flows from the hosts of blocked pages
against the links' direction. Both are counted in pages: a host's seed is the
number of its pages that rules allow (block). A host is blocked if its distrust
exceeds its trust and is large for its pages: rules block :data:`OWN_SHARE` of
them or more, or links to other hosts bring distrust of :data:`LINK_SHARE` of
them. So a few blocked pages do not block a large host, and a host that feeds
blocked ones is blocked by what they pass back.

Links are all ``href`` values that lead to a page. Absolute and scheme-relative
ones lead to their host, relative ones to the own host: a host that links
mostly to itself keeps most of its score. Each direction is normalised over all
links of a host; a host without links in a direction keeps what it has. So the
sum of all scores stays the sum of the seeds. Rounds go on until a round moves
less than :data:`REST` of the seeds (at most :data:`ROUNDS`, by when damping has
brought any graph below that); every round is stored in the shared folder.

Defined results: a null address, or one without ``://``, has an empty host
and path, fits no rule, and is judged like any host ("" has no links, so it
is allowed); null html has no links; other schemes (``mailto:``) and fragments
are no links; repeated pages and links count as often as they occur; a host
without distrust is allowed. A rule fits if its path begins the address's path,
so an empty path fits none; of rules that fit, the longest wins. Extra columns
are ignored.
"""

from __future__ import annotations

import string
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from plume.llm.common import stored, text_columns

DAMPING, ROUNDS, REST = 0.85, 60, 1e-4
OWN_SHARE, LINK_SHARE = 0.5, 0.05
#: The address in an href attribute.
HREF = r"""(?i)href\s*=\s*["']?\s*([^"'\s<>]+)"""


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))


def _behind_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased; else empty."""
    host = F.regexp_extract(_behind_scheme(F.coalesce(url, F.lit(""))), r"^([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_behind_scheme(F.coalesce(url, F.lit(""))), r"^[^/?#]*([^?#]*)", 1)


def _pick(rules, host: Column, path: Column, value) -> Column:
    """The value of the longest rule that fits; null if none does."""
    out = None
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, value(rule)) if out is None else out.when(fits, value(rule))
    return F.lit(None).cast("string") if out is None else out


def apply_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, rule_verdict of each page."""
    parts = text_columns(pages, "page_id", "url").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    host, path = F.col("host"), F.col("path")
    return parts.select("page_id", host, path, _pick(rules, host, path, lambda r: r.text).alias("rule"),
                        _pick(rules, host, path, lambda r: r.verdict).alias("rule_verdict"))


def host_edges(pages: DataFrame) -> DataFrame:
    """(source, target, links) between hosts, relative links from a host to itself; summed before the shuffle."""
    links = text_columns(pages, "url", "html").select(
        host_of(F.col("url")).alias("source"),
        F.explode(F.expr(f"regexp_extract_all(html, r'{_sql(HREF)}', 1)")).alias("link"))
    link = F.col("link")
    target = F.when(link.rlike("^(?i)[a-z][a-z0-9+.-]*://"), host_of(link)).when(
        link.startswith("//"), host_of(F.concat(F.lit("x:"), link))).when(
        ~link.rlike("^(?i)(#|[a-z][a-z0-9+.-]*:)"), F.col("source"))
    return links.select("source", target.alias("target")).where("source <> '' AND target <> ''") \
        .groupBy("source", "target").agg(F.count("*").alias("links"))


def _sql(pattern: str) -> str:
    return pattern.replace("'", r"\x27")


def host_pages(judged: DataFrame) -> DataFrame:
    """(host, pages, trust, distrust): how many pages a host has, and how many of them rules allow and block."""
    n = lambda verdict: F.count(F.when(F.col("rule_verdict") == verdict, True)).cast("double")
    return judged.where("host <> ''").groupBy("host").agg(
        F.count("*").alias("pages"), n("allow").alias("trust"), n("block").alias("distrust"))


def _by_kind(hosts: DataFrame) -> DataFrame:
    """(kind, host, score) of the scores that are not 0."""
    return hosts.select("host", F.explode(F.create_map(F.lit("trust"), F.col("trust"), F.lit("distrust"), F.col("distrust")))
                        .alias("kind", "score")).where("score > 0")


def transitions(edges: DataFrame, hosts: DataFrame) -> DataFrame:
    """(kind, from_host, to_host, p): trust along links, distrust against them; a host without links in a direction has
    one to itself. A hub's edges and their totals are stored tables, so adaptive execution can split the hub."""
    both = stored(edges.select(F.lit("trust").alias("kind"), F.col("source").alias("from_host"), F.col("target").alias("to_host"),
                               "links").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("target").alias("from_host"),
                     F.col("source").alias("to_host"), "links")), "directions")
    total = stored(both.groupBy("kind", "from_host").agg(F.sum("links").alias("total")), "totals")
    known = hosts.select("host").unionByName(both.select(F.col("to_host").alias("host"))).distinct().select(
        F.col("host").alias("from_host"), F.explode(F.array(F.lit("trust"), F.lit("distrust"))).alias("kind"))
    alone = known.join(total, ["kind", "from_host"], "left_anti").select(
        "kind", "from_host", F.col("from_host").alias("to_host"), F.lit(1.0).alias("p"))
    return both.join(total, ["kind", "from_host"]).select(
        "kind", "from_host", "to_host", (F.col("links") / F.col("total")).alias("p")).unionByName(alone)


def propagate(start: DataFrame, steps: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING, rest: float = REST) -> DataFrame:
    """(kind, host, score): seeds (kind, host, score) spread over the steps until they rest."""
    begun = start.agg(F.sum("score")).first()[0] or 0.0
    again = start.select("kind", "host", (F.col("score") * (1 - damping)).alias("score"), F.lit(0.0).alias("before"))
    scores = start
    for _ in range(rounds):
        passed = steps.join(scores, (steps["kind"] == scores["kind"]) & (steps["from_host"] == scores["host"])).select(
            steps["kind"], F.col("to_host").alias("host"), (F.col("p") * F.col("score") * damping).alias("score"), F.lit(0.0).alias("before"))
        before = scores.select("kind", "host", F.lit(0.0).alias("score"), F.col("score").alias("before"))
        scores = stored(passed.unionByName(again).unionByName(before).groupBy("kind", "host").agg(
            F.sum("score").alias("score"), F.sum("before").alias("before")), "trust")
        if (scores.agg(F.sum(F.abs(F.col("score") - F.col("before")))).first()[0] or 0.0) <= rest * begun:
            break
    return scores.select("kind", "host", "score")


def host_verdicts(judged: DataFrame, pages: DataFrame) -> DataFrame:
    """(host, trust, distrust, host_verdict) of every host that has pages."""
    hosts = stored(host_pages(judged), "hosts")
    steps = stored(transitions(host_edges(pages), hosts), "steps")
    scores = propagate(stored(_by_kind(hosts), "seeds"), steps)
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0)).alias(kind)
    own = hosts.select("host", "pages", F.col("distrust").alias("blocked"))
    self_ = steps.where("kind = 'distrust' AND from_host = to_host").select(F.col("from_host").alias("host"), F.col("p").alias("kept"))
    by_host = own.join(scores.groupBy("host").agg(of("trust"), of("distrust")), "host").join(self_, "host", "left")
    # What other hosts pass on: the score without the own seed and what the host keeps of it.
    received = F.col("distrust") * (1 - DAMPING * F.coalesce("kept", F.lit(0.0))) - (1 - DAMPING) * F.col("blocked")
    large = (F.col("blocked") >= OWN_SHARE * F.col("pages")) | (received >= LINK_SHARE * F.col("pages"))
    bad = (F.col("distrust") > F.col("trust")) & large
    return by_host.select("host", "trust", "distrust", F.when(bad, "block").otherwise("allow").alias("host_verdict"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row per page."""
    judged = apply_rules(pages, rules)
    hosts = stored(host_verdicts(judged, pages), "hosts")
    out = judged.join(hosts.withColumnRenamed("host", "of"), F.col("host") == F.col("of"), "left")
    return out.select("page_id", "host", "path", "rule",
                      F.coalesce("rule_verdict", "host_verdict", F.lit("allow")).alias("verdict"),
                      F.coalesce("trust", F.lit(0.0)).alias("trust"),
                      F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
