"""Judging urls by rules, and where none fits by trust and distrust that spread over host links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelspark import scratch

#: (rule, verdict); a rule is a host and the beginning of a path. Fixed values of the query op1.
RULES = (("com/en/", "block"), ("example.com/en/7", "allow"), ("net/de/", "allow"), ("example.net/de/8", "block"), ("org/es/", "block"))
#: Share of a host's trust that its links pass on; and what all hosts together may differ by between two tables when it ends (both start at 1).
DAMPING, TOLERANCE = 0.85, 1e-4
#: Rounds between two tables in the shared folder.
ROUNDS_A_TABLE = 5
#: A host is blocked if more than this share of its trust and distrust is distrust.
BLOCK_SHARE = 0.5

_HREF = r"""[^<>]*?(?<![\w-])href\s*=\s*["']?\s*([^"'<>\s]+)"""
_LINK, _BASE = r"(?i)<(?:a|area)\s" + _HREF, r"(?i)<base\s" + _HREF

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null; of equal lengths the one with the longer host."""
    out = None
    for rule, verdict in sorted(rules, key=lambda r: (-len(r[0]), r[0].index("/"), r[0])):
        rule_host, _, rule_path = rule.partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith("/" + rule_path)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _host_of_link(link: Column, base: Column) -> Column:
    """Host that a link leads to: its own after a scheme or ``//``; ``base`` of relative ones; empty for other schemes and fragments."""
    absolute = link.rlike(r"(?i)^[a-z][a-z0-9+.-]*://")
    other = link.rlike(r"(?i)^(?:[a-z][a-z0-9+.-]*:|#)")
    return F.when(absolute, host_of(link)).when(link.startswith("//"), host_of(F.concat(F.lit("x:"), link))).when(other, F.lit("")).otherwise(base)


def host_edges(pages: DataFrame, host: Column, html: Column) -> DataFrame:
    """(src, dst, weight): how many pages of src link to another host dst, by ``a`` or ``area`` elements.

    Links are absolute, protocol-relative, or relative to a ``base`` on another host.
    """
    text = F.coalesce(html, F.lit(""))
    base = _host_of_link(F.regexp_extract(text, _BASE, 1), F.lit(""))
    rows = pages.select(host.alias("src"), base.alias("base"), F.array_distinct(F.regexp_extract_all(text, F.lit(_LINK), F.lit(1))).alias("links")).filter("src <> ''")
    hosts = F.array_distinct(F.transform("links", lambda link: _host_of_link(link, F.col("base"))))
    linked = rows.select("src", F.explode(hosts).alias("dst")).filter("dst <> '' AND dst <> src")
    return linked.groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def spread(edges: DataFrame, seeds: DataFrame, rounds: int | None = None, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust): personalised PageRank from ``seeds`` (host, trusted, blocked).

    Trust starts at the trusted seeds and follows links; distrust starts at the blocked seeds and
    follows links backwards, to those who link there. What reaches a host without further edges
    ends there. Both move in one pass; sums are combined in the map tasks, so a host with very many
    links moves one row a task. Every ``ROUNDS_A_TABLE`` rounds are a table in the shared folder; it
    ends when two such tables differ by at most ``tolerance`` over all hosts together, or after ``rounds``.
    What hosts still miss then is less than ``tolerance`` in all, since each round moves at most
    ``damping`` times what the one before moved.
    """
    nodes = edges.select(F.col("src").alias("host")).union(edges.select("dst")).union(seeds.select("host")).distinct()
    totals = seeds.agg(F.sum("trusted"), F.sum("blocked")).first()
    good, bad = (float(x or 0) for x in totals)
    start = nodes.join(seeds, "host", "left").select(
        "host",
        (F.coalesce("trusted", F.lit(0.0)) / F.lit(good or 1.0)).alias("trust0"),
        (F.coalesce("blocked", F.lit(0.0)) / F.lit(bad or 1.0)).alias("distrust0"),
    )
    out_sum = edges.groupBy(F.col("src").alias("host")).agg(F.sum("weight").alias("out_weight"))
    in_sum = edges.groupBy(F.col("dst").alias("host")).agg(F.sum("weight").alias("in_weight"))
    start = scratch.written(start.join(out_sum, "host", "left").join(in_sum, "host", "left"), "url-nodes")
    ahead = edges.select(F.col("src").alias("from"), F.col("dst").alias("to"), "weight", F.lit(True).alias("forward"))
    back = edges.select(F.col("dst").alias("from"), F.col("src").alias("to"), "weight", F.lit(False).alias("forward"))
    moves = scratch.written(ahead.union(back), "url-moves")
    rank = start.withColumn("trust", F.col("trust0")).withColumn("distrust", F.col("distrust0"))
    done = 0
    while rounds is None or done < rounds:
        step, before = ROUNDS_A_TABLE if rounds is None else min(ROUNDS_A_TABLE, rounds - done), rank
        for _ in range(step):
            sent = moves.join(rank.select(F.col("host").alias("from"), "trust", "distrust", "out_weight", "in_weight"), "from")
            got = sent.groupBy(F.col("to").alias("host")).agg(
                F.sum(F.when(F.col("forward"), F.col("trust") * F.col("weight") / F.col("out_weight"))).alias("t"),
                F.sum(F.when(~F.col("forward"), F.col("distrust") * F.col("weight") / F.col("in_weight"))).alias("d"),
            )
            new = start.join(got, "host", "left").select(start["*"], F.coalesce("t", F.lit(0.0)).alias("t"), F.coalesce("d", F.lit(0.0)).alias("d"))
            rank = new.select(
                *start.columns,
                (F.lit(damping) * F.col("t") + F.lit(1 - damping) * F.col("trust0")).alias("trust"),
                (F.lit(damping) * F.col("d") + F.lit(1 - damping) * F.col("distrust0")).alias("distrust"),
            )
        rank = scratch.written(rank, "url-rank")
        done += step
        if rounds is None:
            old = before.select("host", F.col("trust").alias("old_trust"), F.col("distrust").alias("old_distrust"))
            change = F.abs(F.col("trust") - F.col("old_trust")) + F.abs(F.col("distrust") - F.col("old_distrust"))
            moved = rank.join(old, "host").agg(F.sum(change)).first()[0] or 0.0
            scratch.removed(before)
            if moved <= tolerance:
                break
    return rank.select("host", "trust", "distrust")


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, trust, distrust.

    The longest fitting rule decides. Else the host does: hosts with pages that a rule allows or
    blocks are the seeds, weighed by the share of such pages, and a host is blocked if its distrust
    is more than ``BLOCK_SHARE`` of both; a host that neither reaches is allowed.

    A null url, or one without ``://``, has an empty host and path, no rule, and is allowed; null
    html has no links. Repeated rows are kept and count as pages. ``rules`` is a short list (it
    becomes one expression). Other columns are not read. Empty in, empty out.
    """
    url, html = F.col(url_col), F.col(html_col)
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("r", fitting_rule(F.col("host"), F.col("path"), rules)).select("page_id", "host", "path", "r.rule", F.col("r.verdict").alias("ruled"))
    seeds = rows.filter("host <> ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("ruled") == "allow", 1)).alias("allowed"),
        F.count(F.when(F.col("ruled") == "block", 1)).alias("stopped"),
    )
    seeds = seeds.select("host", (F.col("allowed") / F.col("n")).alias("trusted"), (F.col("stopped") / F.col("n")).alias("blocked"))
    edges = scratch.written(host_edges(pages, host_of(url), html), "url-edges")
    ranks = spread(edges, scratch.written(seeds, "url-seeds"))
    found = rows.join(ranks, "host", "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    by_host = F.when(distrust > F.lit(BLOCK_SHARE) * (trust + distrust), F.lit("block")).otherwise(F.lit("allow"))
    return found.select("page_id", "host", "path", "rule", F.coalesce("ruled", by_host).alias("verdict"), trust.alias("trust"), distrust.alias("distrust"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(spark.read.parquet(f"{sf_dir}/pages.parquet"))
