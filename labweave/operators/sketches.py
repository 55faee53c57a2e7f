"""Mergeable sketches of lab rows per source and day.

A day's row holds counts, HyperLogLog sketches of distinct documents, names and unresolved names, and
a KLL sketch of the results. Rows of any days, sources, runs or micro-batches merge into the sketch of
their union, so a question about any period reads one small row per source, day and run instead of
the records. Distinct counts are within ``DISTINCT_ERROR`` and quantiles' ranks within
``RANK_ERROR`` of the exact ones (about three standard errors). Null values count nowhere; a null
source or day is a group of its own; without numeric results the quantiles are null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from labweave.operators.matching import UNRESOLVED_METHOD

#: Logarithm of HyperLogLog registers, and the KLL sketch's size.
REGISTERS = 12
KLL_SIZE = 200
DISTINCT_ERROR = 0.05
RANK_ERROR = 0.04

COUNTS = ["rows", "unresolved_rows"]
DISTINCT = ["documents", "test_names", "unresolved_names"]
QUANTILES = {"p05": 0.05, "median": 0.5, "p95": 0.95}


def day_sketches(rows: DataFrame) -> DataFrame:
    """``clinic_id, date_str``, counts and sketches of standardised lab rows."""
    unresolved = F.col("normalization_method") == UNRESOLVED_METHOD
    value = F.nullif(F.col("result_value").cast("double"), F.lit(float("nan")))

    def distinct(c: Column) -> Column:
        return F.hll_sketch_agg(c, F.lit(REGISTERS))

    return rows.filter("record_type = 'lab_test'").groupBy("clinic_id", "date_str").agg(
        F.count("*").alias("rows"),
        F.count_if(unresolved).alias("unresolved_rows"),
        distinct(F.col("document_id")).alias("documents"),
        distinct(F.col("test_name_original")).alias("test_names"),
        distinct(F.when(unresolved, F.col("test_name_original"))).alias("unresolved_names"),
        F.kll_sketch_agg_double(value, F.lit(KLL_SIZE)).alias("results"),
    )


def merge_sketches(sketches: DataFrame, *by: str) -> DataFrame:
    """The sketches' rows merged into one per ``by``, still mergeable."""
    return sketches.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in COUNTS],
        *[F.hll_union_agg(c).alias(c) for c in DISTINCT],
        F.kll_merge_agg_double("results").alias("results"))


def read_sketches(merged: DataFrame) -> DataFrame:
    """Estimates in place of the sketches: distinct counts, share of unresolved rows, quantiles."""
    some = F.kll_sketch_get_n_double("results") > 0
    keys = [c for c in merged.columns if c not in {*COUNTS, *DISTINCT, "results"}]
    return merged.select(
        *keys, *COUNTS, (F.col("unresolved_rows") / F.col("rows")).alias("unresolved_rate"),
        *[F.hll_sketch_estimate(c).alias(c) for c in DISTINCT],
        F.kll_sketch_get_n_double("results").alias("results"),
        *[F.when(some, F.kll_sketch_get_quantile_double("results", F.lit(q))).alias(name)
          for name, q in QUANTILES.items()])
