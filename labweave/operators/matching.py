"""Dirty names to dictionary entries: exact, similar, cut at the front, cut at the end.

All tiers work on the distinct normalised names, so their cost follows the vocabulary and
not the row count, and every tier is an equi-join: no pair of a name and an alias is formed
unless they share a text that any acceptable pair must share.
"""

from __future__ import annotations

import difflib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from labweave.functions.text import clean, normalise_medicine, normalise_name
from labweave.operators.skew import HOT_ROWS, join_groups
from labweave.session import checkpoint
from labweave.sources.config import Dims, broadcast_if_small

# Method labels and truncation gates (shortest name, share of the alias).
EXACT = "exact_alias_match"
SIMILAR = "fuzzy_match"
SUFFIX = "suffix_match_truncated_name"
PREFIX = "prefix_match_truncated_name"
UNRESOLVED_METHOD = "unresolved"
EMPTY = "empty"
UNRESOLVED = "UNRESOLVED"
SUFFIX_GATE = (4, 0.75)
PREFIX_GATE = (6, 0.55)
TRUNCATED_CONFIDENCE = 0.99


def distinct_names(df: DataFrame, name: str) -> DataFrame:
    """``name_norm, n``: each normalised name and its rows."""
    return (
        df.filter(clean(name) != "")
        .groupBy(normalise_name(name).alias("name_norm"))
        .agg(F.count("*").alias("n"))
    )


def exact_matches(names: DataFrame, alias: DataFrame) -> DataFrame:
    """``name_norm, canonical`` for names that are an alias."""
    return names.join(
        alias.select(F.col("alias_norm").alias("name_norm"), "canonical"), "name_norm"
    ).select("name_norm", "canonical")


def _fragments(alias: DataFrame, gate: tuple[int, float], at_end: bool) -> DataFrame:
    """Every proper suffix (or prefix) of an alias that is long enough to stand for it, with
    the alias that comes first in the dictionary."""
    shortest, share = gate
    size = F.length("alias_norm")
    cut = alias.filter(size > shortest).withColumn(
        "len", F.explode(F.sequence(F.lit(shortest), size - 1))
    ).filter(F.col("len") >= F.lit(share) * size)
    text = (
        F.right("alias_norm", F.col("len")) if at_end else F.left("alias_norm", F.col("len"))
    )
    return cut.groupBy(text.alias("name_norm")).agg(
        F.min_by("first_canonical", "pool_ord").alias("canonical")
    )


def suffix_matches(names: DataFrame, alias: DataFrame) -> DataFrame:
    """``name_norm, canonical`` for names cut at the front."""
    return names.join(_fragments(alias, SUFFIX_GATE, True), "name_norm").select(
        "name_norm", "canonical")


def prefix_matches(names: DataFrame, alias: DataFrame) -> DataFrame:
    """``name_norm, canonical`` for names cut at the end."""
    return names.join(_fragments(alias, PREFIX_GATE, False), "name_norm").select(
        "name_norm", "canonical")


def _scorer(cutoff: float):
    @F.pandas_udf("struct<accept: double, confidence: double>")
    def score(name: pd.Series, alias: pd.Series) -> pd.DataFrame:
        accept, confidence = [], []
        for n, a in zip(name, alias):
            accept.append(difflib.SequenceMatcher(None, a, n).ratio())
            # Only accepted pairs need the other argument order.
            confidence.append(
                round(difflib.SequenceMatcher(None, n, a).ratio(), 3)
                if accept[-1] >= cutoff else None
            )
        return pd.DataFrame({"accept": accept, "confidence": confidence})

    return score


def similarity_candidates(names: DataFrame, alias: DataFrame, threshold: float) -> DataFrame:
    """``name_norm, alias_norm`` pairs that contain every pair with ratio >= threshold.

    A ratio of t leaves at most d = floor((1 - t) * (la + lb)) characters outside the matched
    blocks, and those blocks are a common subsequence. Cut the alias into d + 1 pieces: at
    least one is untouched, so the name holds it whole, moved by no more than the insertions
    or deletions ahead of it. Joining on that piece, its number and both lengths is an exact
    filter (the partition scheme of segment-based similarity joins).

    Only pairs of lengths that occur on both sides are cut: a name whose length no alias can
    match costs one lookup. Every alias has at least d + 1 characters only above a threshold of
    2/3, so lower ones are refused.
    """
    if threshold <= 2 / 3:
        raise ValueError("similarity thresholds must be above 2/3")
    slack = F.lit(1.0 - threshold)
    lowest = F.lit(threshold / (2.0 - threshold))

    def budget(a, b):
        return F.floor(slack * (a + b) + F.lit(1e-9)).cast("int")

    def pieces(df: DataFrame) -> DataFrame:
        """Piece number, start (0-based) and size of the la-long alias cut into d + 1."""
        d = budget(F.col("la"), F.col("lb"))
        start = F.floor(F.col("piece") * F.col("la") / (F.col("d") + 1)).cast("int")
        stop = F.floor((F.col("piece") + 1) * F.col("la") / (F.col("d") + 1)).cast("int")
        return (
            df.withColumn("d", d)
            .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("d"))))
            .withColumns({"start": start, "size": stop - start})
        )

    named = names.filter("name_norm != ''").select("name_norm", F.length("name_norm").alias("lb"))
    pool = alias.select("alias_norm", F.length("alias_norm").alias("la"))
    # Distinct lengths: at most as many rows as the longest text has characters.
    at_least = F.ceil(F.col("la") * lowest - F.lit(1e-9)).cast("int")
    at_most = F.floor(F.col("la") / lowest + F.lit(1e-9)).cast("int")
    lengths = checkpoint(pool.select("la").filter("la > 0").distinct().withColumn(
        "lb", F.explode(F.sequence(F.greatest(at_least, F.lit(1)), at_most))
    ).join(named.select("lb").distinct(), "lb"), "lengths")
    lengths = broadcast_if_small(lengths)
    a = pieces(pool.join(lengths, "la")).select(
        "la", "lb", "piece", "alias_norm",
        F.substring("alias_norm", F.col("start") + 1, F.col("size")).alias("text"),
    )
    n = pieces(named.join(lengths, "lb"))
    grow = F.col("lb") - F.col("la")
    earliest = F.greatest(F.col("start") - F.floor((F.col("d") - grow) / 2).cast("int"), F.lit(0))
    latest = F.least(
        F.col("start") + F.floor((F.col("d") + grow) / 2).cast("int"), F.col("lb") - F.col("size")
    )
    n = n.withColumns({"from": earliest, "to": latest}).filter(F.col("from") <= F.col("to"))
    n = n.withColumn("at", F.explode(F.sequence("from", "to"))).select(
        "la", "lb", "piece", "name_norm",
        F.substring("name_norm", F.col("at") + 1, F.col("size")).alias("text"),
    )
    return n.join(a, ["la", "lb", "piece", "text"]).select("name_norm", "alias_norm").distinct()


def similar_matches(names: DataFrame, alias: DataFrame, threshold: float = 0.9) -> DataFrame:
    """``name_norm, alias_norm, canonical, score, confidence`` of the best alias whose
    Ratcliff-Obershelp ratio reaches ``threshold``; equal scores go to the later alias in
    text order. ``score`` compares alias with name, ``confidence`` name with alias."""
    pairs = similarity_candidates(names, alias, threshold)
    scored = pairs.withColumn("s", _scorer(threshold)("name_norm", "alias_norm"))
    best = (
        scored.filter(F.col("s.accept") >= threshold)
        .groupBy("name_norm")
        .agg(F.max(F.struct("s.accept", "alias_norm", "s.confidence")).alias("b"))
        .select("name_norm", F.col("b.alias_norm").alias("alias_norm"),
                F.col("b.accept").alias("score"), F.col("b.confidence").alias("confidence"))
    )
    return best.join(alias.select("alias_norm", "canonical"), "alias_norm")


def edit_candidates(names: DataFrame, alias: DataFrame, threshold: float) -> DataFrame:
    """``name_norm, alias_norm`` pairs that contain every pair whose edit similarity
    1 - distance / longer length reaches ``threshold``.

    At most k = floor((1 - threshold) * longer length) edits are allowed. Of k + 1 pieces of the alias one
    is untouched by them, so the name holds it whole, moved by at most k places. Above a threshold of
    1/2 every alias has a character for each piece. Only lengths that occur on both sides are cut.
    """
    if threshold <= 1 / 2:
        raise ValueError("edit similarity thresholds must be above 1/2")
    budget = F.floor(F.lit(1.0 - threshold) * F.greatest("la", "lb") + F.lit(1e-9)).cast("int")
    named = names.filter("name_norm != ''").select("name_norm", F.length("name_norm").alias("lb"))
    pool = alias.filter("alias_norm != ''").select("alias_norm", F.length("alias_norm").alias("la"))
    # Distinct lengths: at most as many rows as the longest text has characters.
    lengths = pool.select("la").distinct().withColumn("lb", F.explode(F.sequence(
        F.ceil(F.col("la") * threshold - 1e-9).cast("int"), F.floor(F.col("la") / threshold + 1e-9).cast("int")
    ))).join(named.select("lb").distinct(), "lb").withColumn("k", budget).filter("abs(la - lb) <= k")
    lengths = broadcast_if_small(checkpoint(lengths, "lengths"))

    def pieces(df: DataFrame) -> DataFrame:
        edge = lambda i: F.floor(i * F.col("la") / (F.col("k") + 1)).cast("int")
        cut = df.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("k"))))
        return cut.withColumns({"start": edge(F.col("piece")), "stop": edge(F.col("piece") + 1)})

    text = lambda c, at: F.substring(c, at + 1, F.col("stop") - F.col("start"))
    a = pieces(pool.join(lengths, "la")).select(
        "la", "lb", "piece", "alias_norm", text("alias_norm", F.col("start")).alias("text"))
    n = pieces(named.join(lengths, "lb"))
    first = F.greatest(F.col("start") - F.col("k"), F.lit(0))
    last = F.least(F.col("start") + F.col("k"), F.col("lb") - (F.col("stop") - F.col("start")))
    n = n.filter(first <= last).withColumn("at", F.explode(F.sequence(first, last))).select(
        "la", "lb", "piece", "name_norm", text("name_norm", F.col("at")).alias("text"))
    return n.join(a, ["la", "lb", "piece", "text"]).select("name_norm", "alias_norm").distinct()


def edit_matches(names: DataFrame, alias: DataFrame, threshold: float = 0.85) -> DataFrame:
    """``name_norm, alias_norm, canonical, distance, score`` of the best alias by edit similarity, without
    Python; equal scores go to the later alias in text order."""
    longer = F.greatest(F.length("name_norm"), F.length("alias_norm"))
    scored = edit_candidates(names, alias, threshold).withColumn(
        "distance", F.levenshtein("name_norm", "alias_norm")).withColumn(
        "score", 1 - F.col("distance") / longer)
    best = scored.filter(F.col("score") >= threshold - 1e-9).groupBy("name_norm").agg(
        F.max(F.struct("score", "alias_norm", "distance")).alias("b"))
    return best.select("name_norm", "b.*").join(alias.select("alias_norm", "canonical"), "alias_norm")


def name_map(names: DataFrame, dims: Dims) -> DataFrame:
    """``name_norm, canonical, method, confidence`` for every distinct name: the first tier
    that answers wins, later tiers see only what is left."""
    exact = exact_matches(names, dims.alias)
    rest = names.select("name_norm").join(exact, "name_norm", "left_anti")
    similar = similar_matches(rest, dims.alias, dims.threshold).select(
        "name_norm", F.col("canonical").alias("c2"), F.col("confidence").alias("s2"))
    suffix = _fragments(dims.alias, SUFFIX_GATE, True).withColumnRenamed("canonical", "c3")
    prefix = _fragments(dims.alias, PREFIX_GATE, False).withColumnRenamed("canonical", "c4")
    found = (
        rest.join(similar, "name_norm", "left")
        .join(suffix, "name_norm", "left")
        .join(prefix, "name_norm", "left")
    )
    later = found.select(
        "name_norm",
        F.coalesce("c2", "c3", "c4").alias("canonical"),
        F.when(F.col("c2").isNotNull(), SIMILAR).when(F.col("c3").isNotNull(), SUFFIX)
        .when(F.col("c4").isNotNull(), PREFIX).otherwise(UNRESOLVED_METHOD).alias("method"),
        F.when(F.col("c2").isNotNull(), F.col("s2"))
        .when(F.coalesce("c3", "c4").isNotNull(), F.lit(TRUNCATED_CONFIDENCE))
        .otherwise(0.0).alias("confidence"),
    )
    return exact.select(
        "name_norm", "canonical", F.lit(EXACT).alias("method"), F.lit(1.0).alias("confidence")
    ).unionByName(later)


def match_names(
    df: DataFrame, name: str, dims: Dims, *, spread: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add ``canonical, method, confidence`` to every row.

    The vocabulary is resolved once and landed. When it fits the broadcast bound the rows are
    not shuffled at all; beyond it, names above ``hot_rows`` are split on the way back.
    """
    names = checkpoint(distinct_names(df, name), "names")
    resolved = name_map(names, dims).join(names, "name_norm")
    rows = df.withColumn("name_norm", F.when(clean(name) != "", normalise_name(name)))
    out = join_groups(rows, resolved, ["name_norm"], spread=spread, hot_rows=hot_rows)
    return out.withColumns({
        "method": F.coalesce("method", F.lit(EMPTY)),
        "confidence": F.coalesce("confidence", F.lit(0.0)),
    }).drop("name_norm")


def match_medicines(df: DataFrame, name: str, medicine: DataFrame) -> DataFrame:
    """Add ``generic_name, drug_class, medicine_type`` from a brand or generic name."""
    m = medicine.select(
        "med_norm", F.col("generic_name").alias("_generic"), F.col("drug_class"), "is_generic")
    joined = df.withColumn("med_norm", normalise_medicine(name)).join(m, "med_norm", "left")
    missing = F.coalesce(F.col(name) == "", F.lit(True))
    kind = (
        F.when(missing, "missing")
        .when(F.col("is_generic"), "generic_confirmed")
        .when(F.col("_generic").isNotNull(), "brand_resolved")
        .otherwise("unmapped_brand_or_generic")
    )
    return joined.withColumns({
        "generic_name": F.when(~missing, F.coalesce("_generic", F.col(name))),
        "drug_class": F.when(~missing, F.col("drug_class")),
        "medicine_type": kind,
    }).drop("med_norm", "_generic", "is_generic")
