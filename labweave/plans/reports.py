"""Reports over the standardised tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from labweave.functions.numbers import range_text, result_text
from labweave.functions.status import QUEUED, severity_rank
from labweave.operators.search import build_index, search_index
from labweave.operators.stats import breakdown

# The filter word that selects repeats in the flagged queue.
REPEATS_ONLY = "WithinReportDuplicate"
QUEUE_COLUMNS = [
    "id", "document_id", "clinic_id", "patient_name", "test_name_canonical",
    "test_name_original", "result_text", "result_value", "unit_canonical", "range_low",
    "range_high", "test_analytics", "flag_reason", "normalization_method", "processed_at",
    "duplicate_within_report",
]


def five_column_view(records: DataFrame) -> DataFrame:
    """One row per test in the fixed five-column shape, with its report's identity."""
    return records.filter("record_type = 'lab_test'").select(
        "document_id", "clinic_id", "patient_name", "uhid",
        F.col("test_name_canonical").alias("Test_Name"),
        result_text("result_value", "result_text").alias("Test_Name_Result"),
        range_text("range_low", "range_high", "range_text").alias("Test_Name_Range"),
        F.coalesce("unit_canonical", "unit_original").alias("Test_Name_Unit"),
        F.col("test_analytics").alias("Test_Name_Analytics"),
    )


def flagged_queue(records: DataFrame, flag: str | None = None, clinic: str | None = None,
                  limit: int = 300) -> DataFrame:
    """Rows to review, outliers first, then invalid ones."""
    repeat = F.coalesce("duplicate_within_report", F.lit(False))
    rows = records.filter(F.col("test_analytics").isin(QUEUED) | repeat)
    if flag == REPEATS_ONLY:
        rows = rows.filter(repeat)
    elif flag:
        rows = rows.filter(F.col("test_analytics") == flag)
    if clinic:
        rows = rows.filter(F.col("clinic_id") == clinic)
    return rows.select(*QUEUE_COLUMNS).orderBy(severity_rank("test_analytics"), "id").limit(limit)


#: What a search shows, and the columns that it looks into.
SEARCH_SHOWN = ["document_id", "clinic_id", "patient_name", "uhid", "hospital_name"]
SEARCHED = ["document_id", "uhid", "patient_name"]


def index_records(records: DataFrame, path: str) -> None:
    """Write the index that :func:`indexed_search` reads."""
    build_index(records, path, SEARCH_SHOWN, SEARCHED)


def indexed_search(spark: SparkSession, path: str, q: str, limit: int = 50) -> DataFrame:
    """:func:`record_search` through the index at ``path``, without a scan of the records."""
    return search_index(spark, path, q, SEARCHED, limit=limit)


def record_search(records: DataFrame, q: str, limit: int = 50) -> DataFrame:
    """Documents whose id, patient id or patient name contains ``q``, in any case; ``%`` and
    ``_`` in the term are wildcards."""
    pattern = f"%{q.strip()}%"
    cols = ["document_id", "clinic_id", "patient_name", "uhid", "hospital_name"]
    hit = F.ilike("document_id", F.lit(pattern)) | F.ilike("uhid", F.lit(pattern)) | F.ilike(
        "patient_name", F.lit(pattern))
    return records.filter(hit).select(*cols).distinct().orderBy(*cols).limit(limit)


def record_detail(records: DataFrame, audit: DataFrame, document_id: str) -> DataFrame:
    """All rows of one document beside its raw body, by record type and page."""
    raw = audit.filter(F.col("document_id") == document_id).select(
        "document_id", F.to_json("raw").alias("raw_json"))
    rows = records.filter(F.col("document_id") == document_id)
    return rows.join(raw, "document_id", "left").orderBy(
        "record_type", F.col("page_number").try_cast("int"), "id")


def repeated_values(records: DataFrame) -> DataFrame:
    return records.filter("duplicate_within_report").select(
        "document_id", "test_name_canonical", "result_text", "page_number", "flag_reason")


def restatement_audit(records: DataFrame) -> DataFrame:
    """Equal results of one document found on more than one page.

    Distinct pages are reduced first, so a value repeated very often is one row per page by
    the time it is counted.
    """
    keys = ["document_id", "test_name_canonical", "result_text"]
    return (
        records.select(*keys, "page_number").distinct()
        .groupBy(*keys)
        .agg(F.count("page_number").alias("pages"))
        .filter("pages > 1")
    )


def recent_errors(errors: DataFrame, n: int = 10) -> DataFrame:
    return errors.orderBy(F.desc("occurred_at"), "file_path", "reason", "detail").limit(n)


def latest_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("finished_at"), "run_id").limit(1)


def dashboard(records: DataFrame, runs: DataFrame, errors: DataFrame) -> dict[str, DataFrame]:
    """The summary page's parts."""
    return {
        "last_run": latest_run(runs),
        "total_runs": runs.agg(F.count("*").alias("c")),
        "total_records": records.agg(F.count("*").alias("c")),
        "flagged_breakdown": breakdown(records, "test_analytics", nulls=False),
        "record_type_breakdown": breakdown(records, "record_type"),
        "error_count": errors.agg(F.count("*").alias("c")),
        "recent_errors": recent_errors(errors),
    }


def clinic_quality(stats: DataFrame) -> DataFrame:
    return stats.orderBy("clinic_id")


def clinic_list(records: DataFrame) -> DataFrame:
    return records.select("clinic_id").distinct().orderBy("clinic_id")
