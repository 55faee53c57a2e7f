"""URL filter rules: expand, equi-join on short digests, confirm, apply precedence.

A rule is a host and a path start with a verdict. A url is expanded into every host suffix times
every path prefix whose length some rule has; each expression is hashed, and the first
``PREFIX`` hex digits of the digest are the join key, so that the rule table can be looked up
without moving the urls. Whole digests then confirm. Of the rules that fit, the longest wins
(host and path together; ties: the longer host, then block ahead of allow).

A null url, or one without ``://``, has an empty host and path. A url that no rule fits gets
the ``default`` verdict and a null rule. Repeated urls each get their row; extra columns are
ignored; an empty rule table leaves the default everywhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from labweave.llm.common import ascii_lower
from labweave.session import checkpoint
from labweave.sources.config import fits_broadcast

#: Hex digits of the digest that the join compares.
PREFIX = 8


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to ``/ ? #``, A-Z lowered) and path (up to ``? #``)."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return (ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)),
            F.regexp_extract(rest, r"^[^/?#]*(/[^?#]*)", 1))


def rule_table(rules: DataFrame) -> DataFrame:
    """``host, path, verdict`` rows with their digests; one row per expression."""
    rules = rules.select(
        ascii_lower(F.coalesce("host", F.lit(""))).alias("rule_host"),
        F.coalesce("path", F.lit("")).alias("rule_path"),
        F.col("verdict").alias("rule_verdict"))
    once = rules.groupBy("rule_host", "rule_path").agg(F.max("rule_verdict").alias("rule_verdict"))
    return once.select("*", _digest(F.col("rule_host"), F.col("rule_path")).alias("rule_digest"))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def expressions(host: str, path: str, lengths: list[int]) -> Column:
    """Array of (host suffix, path prefix) structs; ``lengths`` are the rules' path lengths, at
    most as many as the longest path has characters."""
    labels = F.split(F.col(host), r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(
        F.filter(F.lit(lengths).cast("array<int>"), lambda n: n <= F.length(path)),
        lambda n: F.substring(F.col(path), F.lit(1), n))
    return F.flatten(F.transform(suffixes, lambda h: F.transform(
        prefixes, lambda p: F.struct(h.alias("h"), p.alias("p")))))


def judge_urls(
    pages: DataFrame, rules: DataFrame, *, key: str = "page_id", url: str = "url",
    default: str = "allow",
) -> DataFrame:
    """``key, host, path, rule, verdict``, one row per row of ``pages``.

    Distinct (host, path) pairs are judged once. Only pairs that share a short digest with a
    rule are moved; their verdicts are looked up by pair, as a broadcast if measured small.
    """
    table = checkpoint(rule_table(rules), "url-rules")
    lengths = sorted(r[0] for r in table.select(F.length("rule_path")).distinct().collect())
    host, path = split_url(F.col(url))
    parsed = pages.select(F.col(key), host.alias("host"), path.alias("path"))
    pairs = parsed.select("host", "path").distinct()
    grown = pairs.select("host", "path", F.explode(expressions("host", "path", lengths)).alias("x"))
    grown = grown.select("host", "path", _digest(F.col("x.h"), F.col("x.p")).alias("digest"))
    short = table.select("*", F.substring("rule_digest", 1, PREFIX).alias("short"))
    short = F.broadcast(short) if fits_broadcast(table) else short
    found = grown.withColumn("short", F.substring("digest", 1, PREFIX)).join(short, "short").filter(
        "digest = rule_digest")
    best = found.groupBy("host", "path").agg(F.max(F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("size"),
        F.length("rule_host").alias("host_size"), F.col("rule_verdict").alias("verdict"),
        F.concat("rule_host", "rule_path").alias("rule"))).alias("best"))
    return parsed.join(best, ["host", "path"], "left").select(
        F.col(key), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
