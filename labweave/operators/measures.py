"""From matched rows to classified measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from labweave.functions.numbers import convert_value, parse_range, with_number
from labweave.functions.status import classify, range_source, unit_mismatch
from labweave.functions.text import clean
from labweave.session import in_parts
from labweave.sources.config import Dims


def add_units(df: DataFrame, unit: str, unit_dim: DataFrame) -> DataFrame:
    """Add ``factor, unit_known, unit_to``: the trimmed spelling first, then lower case."""
    key = clean(F.coalesce(F.col(unit), F.lit("")))
    given = unit_dim.select(
        F.col("unit_key").alias("_k1"), F.struct("unit_to", "factor").alias("_u1"))
    lower = unit_dim.select(
        F.col("unit_key").alias("_k2"), F.struct("unit_to", "factor").alias("_u2"))
    j = df.join(given, key == F.col("_k1"), "left").join(lower, F.lower(key) == F.col("_k2"), "left")
    u = F.coalesce("_u1", "_u2")
    return j.withColumns({
        "unit_known": in_parts(u.isNotNull()), "unit_to": u["unit_to"], "factor": u["factor"],
    }).drop("_k1", "_u1", "_k2", "_u2")


def canonical_unit(unit: str) -> Column:
    """Unit to store: the known unit's, else the expected one, else the spelling as given."""
    expected = F.nullif("unit_expected", F.lit(""))
    return F.when(
        F.col("unit_known"), F.coalesce(F.nullif("unit_to", F.lit("")), F.col("unit_expected"))
    ).otherwise(F.coalesce(expected, F.nullif(F.col(unit), F.lit(""))))


def measure(
    df: DataFrame, dims: Dims, *, result: str = "result_text", unit: str = "unit_original",
    range_: str = "range_text", compare_on: str = "raw", range_from: str = "config",
) -> DataFrame:
    """Parse, convert and classify rows that carry ``canonical`` (null when unresolved).

    Adds ``number, result_value, unit_canonical, range_low, range_high, range_source,
    status, reason, exclude``. ``compare_on="raw"`` compares the number as reported and
    ``"converted"`` the one in the canonical unit; ``range_from="reported_first"`` lets the
    report's own range decide above/below where it has one.
    """
    rows = add_units(df.join(dims.test, "canonical", "left"), unit, dims.unit)
    rows = with_number(rows, result).withColumns({
        "reported": parse_range(range_),
        "unit_canonical": canonical_unit(unit),
        "value_type": F.coalesce("value_type", F.lit("text")),
    })
    rows = rows.withColumn("result_value", convert_value(F.col("number.value"), "factor"))
    low, high = F.col("cfg_low"), F.col("cfg_high")
    if range_from == "reported_first":
        low, high = F.coalesce("reported.low", low), F.coalesce("reported.high", high)
    rows = rows.withColumn("verdict", in_parts(classify(
        name="canonical", value_type="value_type", number="number",
        value=F.col("result_value") if compare_on == "converted" else None,
        unit="unit_canonical", expected_unit="unit_expected", low=low, high=high,
        outlier_low="outlier_low", outlier_high="outlier_high",
    )))
    return rows.withColumns({
        "range_source": range_source("reported.low", "cfg_low"),
        "range_low": F.coalesce("reported.low", "cfg_low"),
        "range_high": F.coalesce("reported.high", "cfg_high"),
        "status": F.col("verdict.status"),
        "reason": F.col("verdict.reason"),
        # Same as the verdict's, from the units alone: a filter on it is pushed down to them
        # and does not carry the parsing along.
        "exclude": (F.col("value_type") != "text") & unit_mismatch("unit_canonical", "unit_expected"),
    }).drop("verdict", "reported", "unit_known", "unit_to", "factor", "cfg_low", "cfg_high",
            "outlier_low", "outlier_high")
