"""Counts over files and rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from labweave.functions.status import FLAGGED, INVALID, OUTLIER
from labweave.operators.matching import UNRESOLVED_METHOD

FILE_COUNTS = ["files_seen", "files_failed", "duplicates_suppressed"]
ROW_COUNTS = [
    "rows_loaded", "unresolved_test_names", "invalid_rows", "outlier_rows",
    "within_report_duplicate_rows",
]


def clinic_stats(files: DataFrame, suppressed: DataFrame, rows: DataFrame) -> DataFrame:
    """Eight counts per clinic.

    ``files`` has ``clinic_id, reason`` (null reason = usable), ``suppressed`` has
    ``clinic_id`` and ``rows`` the standardised rows ahead of the collapse by id. Each input
    is reduced to one row per clinic before they meet.
    """
    f = files.groupBy("clinic_id").agg(
        F.count("*").alias("files_seen"), F.count("reason").alias("files_failed"))
    s = suppressed.groupBy("clinic_id").agg(F.count("*").alias("duplicates_suppressed"))
    r = rows.groupBy("clinic_id").agg(
        F.count("*").alias("rows_loaded"),
        F.count_if(F.col("normalization_method") == UNRESOLVED_METHOD).alias("unresolved_test_names"),
        F.count_if(F.col("test_analytics") == INVALID).alias("invalid_rows"),
        F.count_if(F.col("test_analytics") == OUTLIER).alias("outlier_rows"),
        F.count_if(F.col("duplicate_within_report")).alias("within_report_duplicate_rows"),
    )
    joined = f.join(s, "clinic_id", "full").join(r, "clinic_id", "full")
    return joined.select(
        "clinic_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in FILE_COUNTS + ROW_COUNTS])


def run_summary(files: DataFrame, suppressed: DataFrame, rows: DataFrame, loaded: DataFrame) -> DataFrame:
    """The six counts of one run; ``loaded`` are the rows left after the collapse by id."""
    parts = [
        files.agg(F.count("*").alias("files_seen"), F.count("reason").alias("files_failed")),
        suppressed.agg(F.count("*").alias("duplicates_suppressed")),
        loaded.agg(F.count("*").alias("rows_loaded")),
        rows.agg(F.count_if(F.col("test_analytics").isin(FLAGGED)).alias("rows_flagged")),
    ]
    one = parts[0]
    for p in parts[1:]:
        one = one.unionByName(p, allowMissingColumns=True)
    one = one.agg(*[F.sum(c).alias(c) for c in one.columns])
    return one.select(
        "files_seen",
        (F.col("files_seen") - F.col("files_failed") - F.col("duplicates_suppressed")).alias(
            "files_processed"),
        "files_failed", "duplicates_suppressed", "rows_loaded", "rows_flagged",
    )


def breakdown(df: DataFrame, by: str, *, nulls: bool = True) -> DataFrame:
    """Rows per value, largest first."""
    rows = df if nulls else df.filter(F.col(by).isNotNull())
    return rows.groupBy(by).agg(F.count("*").alias("c")).orderBy(F.desc("c"), by)


def unresolved_names(rows: DataFrame) -> DataFrame:
    """Names no dictionary entry took, with their rows, in text order."""
    return (
        rows.filter(F.col("normalization_method") == UNRESOLVED_METHOD)
        .groupBy("test_name_original")
        .agg(F.count("*").alias("n"))
        .orderBy("test_name_original")
    )


def unresolved_rate(rows: DataFrame, day: Column | str = "processed_at") -> DataFrame:
    """Share of unresolved rows per clinic and day."""
    d = F.to_date(F.col(day) if isinstance(day, str) else day)
    return rows.groupBy("clinic_id", d.alias("day")).agg(
        F.count("*").alias("n"),
        F.avg((F.col("normalization_method") == UNRESOLVED_METHOD).cast("double")).alias(
            "unresolved_rate"),
    )


def error_rate(files: DataFrame, day: Column, *, alert_above: float | None = None) -> DataFrame:
    """Share of failed files per day, only days above ``alert_above`` when it is given."""
    out = files.groupBy(F.to_date(day).alias("day")).agg(
        F.count("*").alias("seen"),
        F.count("reason").alias("failed"),
        (F.count("reason") / F.count("*")).alias("error_rate"),
    )
    return out if alert_above is None else out.filter(F.col("error_rate") > alert_above)
