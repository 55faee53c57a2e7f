"""Dead letters run again after the configuration was mended, in place of what they left behind."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from labweave.operators import sinks, snapshots
from labweave.operators.dedup import greedy_kept, placed, split_by_kept, suppressed_rows
from labweave.operators.skew import HOT_ROWS
from labweave.operators.sketches import day_sketches
from labweave.operators.stats import FILE_COUNTS, ROW_COUNTS, clinic_stats, run_summary
from labweave.plans.pipeline import (
    RunResult, loaded_ids, standardise, unresolved_errors, write_result,
)
from labweave.session import checkpoint, configure
from labweave.sources.config import Dims, dims_from_folder, fits_broadcast, measured
from labweave.sources.files import (
    file_errors, good_documents, parse_documents, qualified, read_files,
)

#: Up to so many folders with letters are read on their own; beyond it the whole root is listed.
MAX_FOLDERS = 1_000


def failed_files(spark: SparkSession, out: str, reasons: Sequence[str] = ()) -> DataFrame:
    """Files with a dead letter (of one of ``reasons``, if given): ``file_path, clinic_id``, in how many
    runs or batches they left letters (``seen``) and in how many they failed as a whole (``failed``)."""
    files = sinks.error_log(spark, f"{out}/dead_letter").groupBy("file_path").agg(
        F.max("clinic_id").alias("clinic_id"),
        F.countDistinct("run").cast("int").alias("seen"),
        F.countDistinct(F.when(F.col("stage") == "ingestion", F.col("run"))).cast("int").alias("failed"),
        F.bool_or(F.col("reason").isin(*reasons) if reasons else F.lit(True)).alias("_asked"))
    return files.filter("_asked").drop("_asked")


def replay(
    spark: SparkSession, root: str, config: str | Dims, out: str, *, reasons: Sequence[str] = (),
    **options,
) -> RunResult | None:
    """Run the files below ``root`` that left dead letters at ``out`` again, by the configuration given.

    Only the folders with such files are read. See :func:`replay_files`.
    """
    configure(spark)
    dims = config if isinstance(config, Dims) else dims_from_folder(spark, config)
    folders = [r[0] for r in failed_files(spark, out, reasons).select(
        F.regexp_replace("file_path", "/[^/]*$", "").alias("folder")).distinct().limit(MAX_FOLDERS + 1).collect()]
    if not folders:
        return None
    start = qualified(spark, root) + "/"
    there = []
    if len(folders) <= MAX_FOLDERS:
        fs, _ = snapshots.filesystem(spark, root)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        there = [f for f in folders if f"{f}/".startswith(start) and fs.exists(path(f))]
        if not there:
            return None
    return replay_files(read_files(spark, root, folders=there), dims, out, reasons=reasons, **options)


def replay_files(
    files: DataFrame, dims: Dims, out: str, *, reasons: Sequence[str] = (), dedup: bool = True,
    hot_rows: int = HOT_ROWS, **options,
) -> RunResult | None:
    """Run those of ``files`` that left dead letters again and publish the outcome as one snapshot.

    Their rows, letters and audit rows are retracted and written anew; counts by source get the
    difference as rows of this run, in which each file counts once; the sketches of the days touched
    are built again from the audit. The rest of the tables is not rewritten. A file that is not among
    ``files`` any more keeps what it has. None if there is nothing to run.

    A document kept before stays kept. One that could not be read before arrives after all that are
    kept, as in a stream's next batch; so the tables equal those of a full run by the new
    configuration, unless it is a copy of a kept one that comes later in path order, or the new
    configuration also changes files without letters. A row's id shared with another file's goes
    to the file run last.
    """
    spark = files.sparkSession
    started = spark.sql("select now()").first()[0]
    asked = checkpoint(failed_files(spark, out, reasons), "letters")
    if asked.isEmpty():
        return None
    # Beyond the broadcast bound the list is hashed, so that no bodies are sorted.
    list_ = asked.select("file_path")
    list_ = F.broadcast(list_) if fits_broadcast(list_) else list_.hint("shuffle_hash")
    parsed = checkpoint(parse_documents(files.join(list_, "file_path", "left_semi"), dims.clinic), "documents")
    again = checkpoint(asked.join(measured(parsed.select("file_path")), "file_path", "left_semi"), "replayed")
    if again.isEmpty():
        return None

    audit = sinks.read_table(spark, f"{out}/audit")
    paths = measured(again.select(F.col("file_path").alias("source_file")))
    # Only what is counted of the rows moves, no bodies.
    before = checkpoint(_narrow(audit, *_COUNTED).join(paths, "source_file", "left_semi"), "before")
    good = good_documents(parsed)
    docs, dropped = good, good.limit(0)
    if dedup:
        good = good_documents(placed(parsed))
        was_kept = measured(before.select(F.col("source_file").alias("file_path")))
        stay = good.join(was_kept, "file_path", "left_semi")
        come = good.join(was_kept, "file_path", "left_anti")
        seen = audit.join(paths, "source_file", "left_anti").select("dedup_key", "content_hash").unionByName(
            stay.select("dedup_key", "content_hash")).toDF("k", "h")
        kept = greedy_kept(come, seen=seen, hot_rows=hot_rows).select("path_parts").unionByName(
            stay.select("path_parts"))
        docs, dropped = split_by_kept(good, checkpoint(kept, "kept"), "path_parts")

    rows, errors = standardise(docs, dims, hot_rows=hot_rows, **options)
    rows = checkpoint(rows, "rows")
    suppressed = suppressed_rows(dropped)
    old_rows = _audited(before)
    result = RunResult(
        run_id=f"replay-{uuid.uuid4()}", documents=docs, suppressed=suppressed, rows=rows,
        errors=file_errors(parsed).unionByName(errors).unionByName(unresolved_errors(rows)),
        stats=_difference(clinic_stats(parsed, suppressed, rows), _stats_before(again, old_rows)),
        summary=run_summary(parsed, suppressed, rows, loaded_ids(rows)),
    )
    place = ["clinic_id", "date_str"]
    days = checkpoint(old_rows.select(*place).unionByName(rows.select(*place)).distinct(), "days")
    more = {"quality": _days_anew(
        _narrow(audit, *_SKETCHED).join(paths, "source_file", "left_anti"), rows, days).withColumn(
        "run", F.lit(result.run_id))}
    if "kept_keys" in snapshots.snapshot(spark, out).tables:  # a stream's history
        more["kept_keys"] = docs.select(F.col("dedup_key").alias("k"), F.col("content_hash").alias("h"))
    write_result(result, out, started=started, more=more, gone={
        "records": again.select("file_path"), "dead_letter": again.select("file_path"),
        "audit": again.select(F.col("file_path").alias("source_file")), "quality": days})
    return result


#: Columns of the audited rows that statistics and days are counted from, and those of the sketches.
_COUNTED = ["date_str", "normalization_method", "test_analytics", "duplicate_within_report"]
_SKETCHED = ["date_str", "record_type", "document_id", "test_name_original", "normalization_method",
             "result_value"]


def _narrow(audit: DataFrame, *columns: str) -> DataFrame:
    """Files with their source and, as one array each, these columns of the rows kept beside them."""
    return audit.select("source_file", "clinic_id", *[F.col(f"rows.{c}").alias(c) for c in columns])


def _audited(narrow: DataFrame) -> DataFrame:
    """The standardised rows kept beside the documents."""
    columns = [c for c in narrow.columns if c not in ("source_file", "clinic_id")]
    return narrow.select("clinic_id", F.explode(F.arrays_zip(*columns)).alias("_row")).select(
        "clinic_id", *[F.col(f"_row.{c}").alias(c) for c in columns])


def _stats_before(again: DataFrame, rows: DataFrame) -> DataFrame:
    files = again.select(
        "clinic_id", "failed", F.explode(F.sequence(F.lit(1), F.col("seen"))).alias("i")
    ).select("clinic_id", F.when(F.col("i") <= F.col("failed"), F.lit("")).alias("reason"))
    return clinic_stats(files, files.limit(0), rows)


def _difference(now: DataFrame, before: DataFrame) -> DataFrame:
    counts = FILE_COUNTS + ROW_COUNTS
    taken = before.select("clinic_id", *[(-F.col(c)).alias(c) for c in counts])
    return now.unionByName(taken).groupBy("clinic_id").agg(*[F.sum(c).alias(c) for c in counts])


def _days_anew(audit: DataFrame, rows: DataFrame, days: DataFrame) -> DataFrame:
    """Sketches of ``days`` from the audited rows of other files and the rows run again."""
    day = [F.col("clinic_id").alias("_clinic"), F.col("date_str").alias("_day")]
    others = audit.join(days.select("clinic_id").distinct(), "clinic_id", "left_semi")
    others = _audited(others).join(
        days.select(*day), F.col("clinic_id").eqNullSafe(F.col("_clinic"))
        & F.col("date_str").eqNullSafe(F.col("_day")), "left_semi")
    return day_sketches(others.unionByName(rows.select(*others.columns)))
