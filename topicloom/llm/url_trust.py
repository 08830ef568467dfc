"""Verdicts on urls by rules, and by trust and distrust spread over links between hosts.

Rules name a host and the start of a path; they hold for the host and its subdomains, and
the longest one that fits decides. For the other urls, hosts are judged by two personalised
PageRanks: trust starts at hosts in the proportion of their pages that rules allow and
follows links; distrust starts where rules block and follows links backwards, to those that
link to blocked hosts. A host is blocked when distrust makes up more than ``limit`` of both.

Links are absolute and protocol-relative addresses in the pages' ``href`` and ``src``
attributes; links within a host say nothing. A host and its parent domain are linked both
ways. Rank that reaches a host without links is given back to the seeds, which only
rescales the ranks, so both are scaled to a sum of 1 at the end.

Defined cases: a null url, or one without ``://``, has empty host and path; a null page has
no links; hosts that no rank reaches are allowed; repeated rows count as often as they
occur. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from topicloom.llm.common import LOWER, UPPER, stored
from topicloom.runtime import lookup_join


@dataclass(frozen=True)
class Spread:
    """``steps`` steps are taken between two looks at the ranks, until no further host is reached
    and no host's share of distrust moves by more than ``tolerance``; ``limit`` is the largest
    share of distrust that is allowed."""

    damping: float = 0.75
    steps: int = 4
    tolerance: float = 0.005
    limit: float = 0.5


def _folded(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host with A-Z in lower case, and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return _folded(F.regexp_extract(rest, "^([^/?#]*)", 1)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest of the rules ``(verdict, host/path)`` that fits and its verdict, or null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the last one wraps all others
        name, _, start = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + start))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def with_rules(pages: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """``(page_id, host, path, rule, decided)``."""
    host, path = split_url(F.col("url"))
    placed = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, decided = rule_of(F.col("host"), F.col("path"), rules)
    return placed.select("page_id", "host", "path", rule.alias("rule"), decided.alias("decided"))


def host_links(pages: DataFrame) -> DataFrame:
    """``(src, dst, n)``: how many links pages of one host have to another."""
    attribute = "(?i)\\b(?:href|src)\\s*=\\s*[\"']?\\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\\s<>]+)"
    targets = F.when(F.instr("html", "//") > 0, F.regexp_extract_all("html", F.lit(attribute), 1))
    links = pages.select(split_url(F.col("url"))[0].alias("src"), F.explode(targets).alias("dst"))
    links = links.select("src", _folded(F.col("dst")).alias("dst")).where("src != '' and dst != '' and src != dst")
    return links.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def parent_links(hosts: DataFrame) -> DataFrame:
    """Links both ways between every host and its parent domains of two labels or more."""
    labels = F.split("host", "\\.")
    # suffixes of two labels or more, the longest first
    chain = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    steps = F.arrays_zip(F.slice(chain, 1, F.size(chain) - 1).alias("low"), F.slice(chain, 2, F.size(chain)).alias("up"))
    pairs = hosts.where(F.size(labels) > 2).select(F.explode(steps).alias("x")).select("x.low", "x.up").distinct()
    return pairs.select(F.col("low").alias("src"), F.col("up").alias("dst"), F.lit(1).cast("long").alias("n")).unionByName(
        pairs.select(F.col("up").alias("src"), F.col("low").alias("dst"), F.lit(1).cast("long").alias("n"))
    )


def arcs_of(links: DataFrame) -> DataFrame:
    """``(here, there, trust, distrust)``: shares of a host's trust that go along its links,
    and of its distrust that go to those which link to it."""
    links = links.groupBy("src", "dst").agg(F.sum("n").alias("n"))
    given = links.groupBy("src").agg(F.sum("n").alias("given"))
    taken = links.groupBy("dst").agg(F.sum("n").alias("taken"))
    shares = links.join(given, "src").join(taken, "dst")
    ahead = shares.select(
        F.col("src").alias("here"), F.col("dst").alias("there"), (F.col("n") / F.col("given")).alias("trust"), F.lit(0.0).alias("distrust")
    )
    back = shares.select(
        F.col("dst").alias("here"), F.col("src").alias("there"), F.lit(0.0).alias("trust"), (F.col("n") / F.col("taken")).alias("distrust")
    )
    return ahead.unionByName(back)


def spread(seeds: DataFrame, arcs: DataFrame, how: Spread = Spread()) -> DataFrame:
    """``(host, trust, distrust)`` from seeds of the same columns; each rank sums to 1 or 0.

    What decides is every host's own share of distrust, so hosts of little rank, far from all
    seeds, are waited for like any other. Ranks converge like powers of ``damping``, so there is
    an end; steps over the graph are only as many as its longest way to a seed asks for.
    """

    def scaled(df: DataFrame) -> DataFrame:
        sums = df.agg(F.sum("trust").alias("t"), F.sum("distrust").alias("d")).first()
        t, d = (sums["t"] or 0.0) or 1.0, (sums["d"] or 0.0) or 1.0
        return df.select("host", (F.col("trust") / t).alias("trust"), (F.col("distrust") / d).alias("distrust"))

    seeds = scaled(seeds)
    start = seeds.select("host", *[(F.col(c) * (1 - how.damping)).alias(c) for c in ("trust", "distrust")])
    share = F.col("distrust") / F.nullif(F.col("trust") + F.col("distrust"), F.lit(0.0))
    state = stored(seeds, "host_ranks")
    while True:
        old = state.select("host", share.alias("before"))
        for _ in range(how.steps):
            moved = arcs.join(state.withColumnsRenamed({"trust": "t", "distrust": "d", "host": "here"}), "here").select(
                F.col("there").alias("host"),
                (F.col("t") * F.col("trust") * how.damping).alias("trust"),
                (F.col("d") * F.col("distrust") * how.damping).alias("distrust"),
            )
            state = moved.unionByName(start).groupBy("host").agg(
                F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")
            )
        state = stored(state, "host_ranks")
        # a host whose share was or is null has just been reached, or can't be
        unsettled = ~F.coalesce(F.abs(share - F.col("before")) <= how.tolerance, share.isNull())
        if state.join(old, "host", "left").where(unsettled).isEmpty():
            return scaled(state)


def host_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str]], how: Spread = Spread()) -> DataFrame:
    """``(host, trust, distrust, host_verdict)`` of every host that a page or a link names."""
    judged = with_rules(pages, rules).where("host != ''")
    seeds = stored(
        judged.groupBy("host").agg(
            F.sum((F.col("decided") == "allow").cast("double")).alias("trust"),
            F.sum((F.col("decided") == "block").cast("double")).alias("distrust"),
        ).na.fill(0.0),
        "host_seeds",
    )
    links = stored(host_links(pages), "host_links")
    hosts = seeds.select("host").unionByName(links.select(F.col("dst").alias("host"))).distinct()
    arcs = stored(arcs_of(links.unionByName(parent_links(hosts))), "host_arcs")
    ranks = spread(seeds, arcs, how)
    blocked = F.col("distrust") > how.limit * (F.col("trust") + F.col("distrust"))
    return ranks.withColumn("host_verdict", F.when(blocked, "block").otherwise("allow"))


def url_verdicts(pages: DataFrame, rules: Sequence[tuple[str, str]], how: Spread = Spread()) -> DataFrame:
    """``(page_id, host, path, rule, verdict, trust, distrust)`` of every page."""
    hosts = stored(host_verdicts(pages, rules, how), "host_verdicts")
    found = lookup_join(with_rules(pages, rules), hosts, "host")
    return found.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("decided", "host_verdict", F.lit("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
