"""The batch run: files to documents to standardised rows to tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from labweave.functions.hashing import id_bytes, row_id
from labweave.functions.numbers import number_text
from labweave.operators import mapping, sinks, snapshots
from labweave.operators.dedup import (
    dedup_documents, flag_repeats, keep_first_landed, placed, suppressed_rows,
)
from labweave.operators.matching import UNRESOLVED, UNRESOLVED_METHOD, match_names
from labweave.operators.measures import measure
from labweave.operators.skew import HOT_ROWS
from labweave.operators.sketches import day_sketches, merge_sketches, read_sketches
from labweave.operators.stats import FILE_COUNTS, ROW_COUNTS, clinic_stats, run_summary
from labweave.session import checkpoint, configure, in_parts
from labweave.sources.config import Dims, dims_from_folder, known_paths
from labweave.sources.files import (
    error_rows, file_errors, good_documents, parse_documents, read_files,
)

LAB_COLUMNS = mapping.LINEAGE + mapping.ORDER + mapping.DEMOGRAPHICS + [
    "record_type", "test_name_canonical", "test_name_original", "result_value", "result_text",
    "result_text_original", "unit_canonical", "unit_original", "range_low", "range_high",
    "range_text", "range_text_original", "range_source", "test_analytics", "flag_reason",
    "normalization_method", "normalization_confidence", "duplicate_within_report", "page_number",
]


def record_id(*, reference_ids: bool = False) -> Column:
    """Content-derived row id. Medications also hash name, dose and frequency, without which
    all medications of a document would share one id; ``reference_ids`` leaves those out."""
    first = lambda *c: F.coalesce(*[F.nullif(F.col(x), F.lit("")) for x in c])
    parts = [
        first("document_id", "file_path"),
        F.col("record_type"),
        first("test_name_canonical", "test_name_original"),
        F.coalesce(number_text("result_value"), F.col("result_text")),
        first("unit_canonical", "unit_original"),
    ]
    base = row_id(parts)
    if reference_ids:
        return base
    return F.when(
        F.col("record_type") == "medication",
        row_id([*parts, "medicine", "dose", "frequency"]),
    ).otherwise(base)


def lab_rows(blocks: DataFrame, dims: Dims, *, scope: str = "block", hot_rows: int = HOT_ROWS,
             **measure_options) -> tuple[DataFrame, DataFrame]:
    """``(kept, excluded)`` measured lab rows, repeats flagged among the kept ones."""
    rows = mapping.test_rows(blocks, known_paths(dims.clinic))
    matched = match_names(rows, "test_name_original", dims, spread=mapping.ORDER, hot_rows=hot_rows)
    measured = measure(matched, dims, **measure_options).withColumns({
        "record_type": F.lit("lab_test"),
        "test_name_canonical": F.coalesce("canonical", F.lit(UNRESOLVED)),
        "test_analytics": F.col("status"),
        "flag_reason": F.col("reason"),
        "normalization_method": F.col("method"),
        "normalization_confidence": F.col("confidence"),
    })
    measured = checkpoint(
        measured.select(*[c for c in LAB_COLUMNS if c != "duplicate_within_report"], "exclude"),
        "lab-rows")
    # Within one block the file and the block are settled, so one number gives the order.
    line = F.shiftleft(F.col("row_ord").cast("long"), 32) + F.col("sub_ord")
    where, order = (["file_path", "block_ord"], ["line"]) if scope == "block" else (
        ["document"], mapping.ORDER)
    kept = flag_repeats(
        placed(measured).filter("not exclude").drop("exclude").withColumns({
            "line": line,
            # A file without an id is a document of its own, as in its rows' ids.
            "document": F.coalesce(F.nullif("document_id", F.lit("")), "file_path")}),
        [*where, "test_name_canonical", "result_text"], order, hot_rows=hot_rows,
    ).drop("line", "document")
    return kept, measured.filter("exclude")


def standardise(docs: DataFrame, dims: Dims, *, reference_ids: bool = False, **options
                ) -> tuple[DataFrame, DataFrame]:
    """``(rows, row_errors)`` of parsed documents: every record type in one wide table, ahead
    of the collapse by id. The errors leave out :func:`unresolved_errors`, which read the rows."""
    blocks = mapping.explode_blocks(mapping.add_lineage(docs), dims.clinic)
    blocks = mapping.land_blocks(blocks, dims.clinic)
    known = known_paths(dims.clinic)
    lab, excluded = lab_rows(blocks, dims, **options)
    rows = (
        lab.unionByName(mapping.discharge_rows(blocks, known), allowMissingColumns=True)
        .unionByName(mapping.medication_rows(blocks, dims.medicine, known), allowMissingColumns=True)
        .withColumn("processed_at", F.current_timestamp())
    )
    rows = rows.withColumn("id", in_parts(record_id(reference_ids=reference_ids)))
    errors = mapping.block_errors(blocks).unionByName(error_rows(
        excluded, "unit_validation", "unit_mismatch_excluded", F.col("flag_reason")))
    return rows, errors


def unresolved_errors(rows: DataFrame) -> DataFrame:
    """Dead letters of rows whose test name no dictionary entry answers."""
    return error_rows(
        rows.filter(F.col("normalization_method") == UNRESOLVED_METHOD),
        "test_name_normalisation", "unresolved_test_name",
        F.concat(F.lit("'"), F.col("test_name_original"),
                 F.lit("' -- add to the test dictionary")))


@dataclass(frozen=True)
class RunResult:
    run_id: str
    documents: DataFrame
    suppressed: DataFrame
    rows: DataFrame
    errors: DataFrame
    stats: DataFrame
    summary: DataFrame


def load_rows(rows: DataFrame) -> DataFrame:
    """Landed rows as stored: the first per id, ordering columns dropped."""
    return keep_first_landed(rows, ["id"], mapping.ORDER, short={"id": id_bytes("id")}).drop(*mapping.ORDER)


def loaded_ids(rows: DataFrame) -> DataFrame:
    """One row per row that :func:`load_rows` keeps."""
    return rows.select(id_bytes("id").alias("id")).distinct()


@dataclass(frozen=True)
class Documents:
    """All files as parsed, and those that are kept and dropped among the usable ones."""

    parsed: DataFrame
    kept: DataFrame
    dropped: DataFrame


def read_documents(files: DataFrame, dims: Dims, *, dedup: bool = True, hot_rows: int = HOT_ROWS) -> Documents:
    """Files parsed, landed once, and relieved of copies; no row of a report is made yet."""
    parsed = checkpoint(parse_documents(files, dims.clinic), "documents")
    return Documents(parsed, *dedup_documents(
        good_documents(placed(parsed)), enabled=dedup, hot_rows=hot_rows))


def process(files: DataFrame | Documents, dims: Dims, *, dedup: bool = True, hot_rows: int = HOT_ROWS,
            **options) -> RunResult:
    """Files, or documents read from them, to results. Parsed documents and standardised rows are
    landed once each, because several outputs read them."""
    docs = files if isinstance(files, Documents) else read_documents(
        files, dims, dedup=dedup, hot_rows=hot_rows)
    parsed, kept = docs.parsed, docs.kept
    rows, row_errors = standardise(kept, dims, hot_rows=hot_rows, **options)
    rows = checkpoint(rows, "rows")
    suppressed = suppressed_rows(docs.dropped)
    return RunResult(
        run_id=str(uuid.uuid4()),
        documents=kept,
        suppressed=suppressed,
        rows=rows,
        errors=file_errors(parsed).unionByName(row_errors).unionByName(unresolved_errors(rows)),
        stats=clinic_stats(parsed, suppressed, rows),
        summary=run_summary(parsed, suppressed, rows, loaded_ids(rows)),
    )


def run(spark: SparkSession, root: str, config: str | Dims, out: str, *, dedup: bool = True,
        reset: bool = False, run_id: str | None = None, **options) -> RunResult:
    """One batch over a report folder, written to ``out``: ``records`` (upsert by id), ``clinic_stats``
    (by source and run), ``runs``, ``dead_letter``, ``audit`` and ``suppressed``, visible together. A run
    repeated under the same ``run_id`` replaces what it wrote."""
    configure(spark)
    started = spark.sql("select now()").first()[0]
    dims = config if isinstance(config, Dims) else dims_from_folder(spark, config)
    result = process(read_files(spark, root), dims, dedup=dedup, **options)
    result = replace(result, run_id=run_id) if run_id else result
    write_result(result, out, reset=reset, started=started)
    return result


def run_log(result: RunResult, started=None) -> DataFrame:
    """One row with the run's counts and times."""
    return result.summary.select(
        F.lit(result.run_id).alias("run_id"),
        F.lit(started).cast("timestamp").alias("started_at"),
        F.current_timestamp().alias("finished_at"), "*")


#: Per table: its keys, its folders, and the columns its rows are looked up by.
LAYOUT = {
    "records": (["id"], ["clinic_id", "date_str"], ["document_id"]),
    "clinic_stats": (["clinic_id", "run"], [], []),
    "dead_letter": ([], [], []),
    "audit": (["source_file"], ["clinic_id"], ["document_id"]),
    "runs": (["run_id"], [], []),
    "suppressed": (["file_path", "run"], [], []),
    "kept_keys": ([], [], []),
    "quality": (["clinic_id", "date_str", "run"], [], []),
}


def write_result(
    result: RunResult, out: str, *, reset: bool = False, started=None, number: int | None = None,
    writer: str | None = None, more: dict[str, DataFrame] | None = None,
    gone: dict[str, DataFrame] | None = None,
) -> bool:
    """Write all tables of a run and make them visible together; a failure ahead of that leaves the
    former state everywhere. ``writer`` and ``number`` name a numbered batch, which counts once.
    ``more`` adds tables or takes the place of a run's own; ``gone`` names values, per table, whose
    rows of former runs go."""
    spark, run_id = result.rows.sparkSession, result.run_id
    tables = {
        "records": load_rows(result.rows),
        "clinic_stats": result.stats.withColumn("run", F.lit(run_id)),
        "dead_letter": sinks.error_delta(result.errors, run_id),
        "audit": sinks.audit_rows(result.documents, result.rows),
        "runs": run_log(result, started),
        "suppressed": result.suppressed.withColumn("run", F.lit(run_id)),
        "quality": day_sketches(result.rows).withColumn("run", F.lit(run_id)),
        **(more or {}),
    }
    deltas = [snapshots.write_retraction(values, out, name, values.columns, run=run_id)
              for name, values in (gone or {}).items()]
    for name, df in tables.items():
        keys, by, lookup = LAYOUT[name]
        deltas.append(snapshots.write_delta(
            df, out, name, run=run_id, keys=keys, by=by, lookup=lookup))
    shown = snapshots.publish(spark, out, deltas, run=writer or run_id, number=number, reset=reset)
    for name in tables:
        snapshots.fold(spark, out, name)
    return shown


def stored_stats(spark: SparkSession, out: str) -> DataFrame | None:
    """Counts per source over all runs and batches whose tables are at ``out``."""
    found = sinks.read_table(spark, f"{out}/clinic_stats")
    return None if found is None else found.groupBy("clinic_id").agg(
        *[F.sum(c).alias(c) for c in FILE_COUNTS + ROW_COUNTS])


def stored_quality(spark: SparkSession, out: str, *by: str, since: str | None = None,
                   until: str | None = None) -> DataFrame | None:
    """Distinct counts and quantiles per ``by`` (``clinic_id``, ``date_str``, both or none) over the days
    from ``since`` to ``until``, merged from the sketches of all runs and batches at ``out``."""
    found = sinks.read_table(spark, f"{out}/quality")
    if found is None:
        return None
    days = [F.col("date_str") >= since] * (since is not None) + [
        F.col("date_str") <= until] * (until is not None)
    for d in days:
        found = found.filter(d)
    return read_sketches(merge_sketches(found, *by))
