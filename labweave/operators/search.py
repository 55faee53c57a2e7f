"""Substring search through an inverted index of three-character grams.

The index holds, for every searchable entity, the distinct grams of its texts in lower case as postings
(gram, entity), sorted by gram, so that a search reads only the row groups of its own grams. An
entity that contains the term has all of the term's grams; the postings of these are intersected by
counting, which spreads a frequent gram over tasks, and the few entities left are confirmed by the
search itself. Entities are distinct rows and much fewer than the records behind them.

A term is cut at its wildcards (``%`` and ``_``); a term whose pieces are all shorter than a gram is
answered by a scan of the entities.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

GRAM = 3


def term_grams(term: str) -> list[str]:
    """The grams that a text must have to match ``%term%``."""
    pieces = re.split(r"[%_\\]", term.lower())
    return sorted({p[i:i + GRAM] for p in pieces for i in range(len(p) - GRAM + 1)})


def _grams(text: Column) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.when(F.length(low) >= GRAM, F.transform(
        F.sequence(F.lit(1), F.length(low) - GRAM + 1), lambda i: F.substring(low, i, GRAM))
    ).otherwise(F.array().cast("array<string>"))


def build_index(rows: DataFrame, path: str, columns: Sequence[str], searched: Sequence[str]) -> None:
    """Write the distinct ``columns`` of ``rows`` and the postings of the ``searched`` ones to ``path``."""
    spark = rows.sparkSession
    entities = rows.select(*columns).distinct()
    keyed = entities.withColumn("entity", F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), c)]))
    keyed.hint("rebalance", "entity").sortWithinPartitions("entity").write.mode("overwrite").parquet(
        f"{path}/entities")
    landed = spark.read.parquet(f"{path}/entities")
    grams = F.array_distinct(F.flatten(F.array(*[_grams(F.col(c)) for c in searched])))
    postings = landed.select(F.explode(grams).alias("gram"), "entity")
    postings.hint("rebalance", "gram").sortWithinPartitions("gram", "entity").write.mode(
        "overwrite").option("parquet.bloom.filter.enabled#gram", "true").parquet(f"{path}/postings")


def candidates(spark: SparkSession, path: str, term: str) -> DataFrame | None:
    """``entity`` of those that have all grams of the term; None if it has no gram."""
    wanted = term_grams(term)
    if not wanted:
        return None
    postings = spark.read.parquet(f"{path}/postings").filter(F.col("gram").isin(wanted))
    # A posting is there once; entities of one hash only add candidates, which are confirmed.
    return postings.groupBy("entity").agg(F.count_distinct("gram").alias("n")).filter(
        F.col("n") == len(wanted)).select("entity")


def search_index(
    spark: SparkSession, path: str, term: str, searched: Sequence[str], *, limit: int = 50
) -> DataFrame:
    """Entities with ``term`` in one of the ``searched`` columns, in any case, in the order of their columns."""
    entities = spark.read.parquet(f"{path}/entities")
    found = candidates(spark, path, term.strip())
    if found is not None:
        entities = entities.join(found, "entity", "left_semi")
    pattern = F.lit(f"%{term.strip()}%")
    hit = reduce(lambda a, b: a | b, [F.ilike(c, pattern) for c in searched])
    columns = [c for c in entities.columns if c != "entity"]
    return entities.filter(hit).select(*columns).distinct().orderBy(*columns).limit(limit)
