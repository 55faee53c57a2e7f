"""Idempotent writes: keyed upsert, append-only logs, raw-beside-rows audit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from labweave.operators import snapshots

ERROR_COLUMNS = ["file_path", "clinic_id", "stage", "reason", "detail", "occurred_at"]


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key the batch does not have, plus the batch. A column on one side
    only is null on the other."""
    stay = target.join(batch.select(*keys), list(keys), "left_anti")
    return stay.select(*target.columns).unionByName(batch, allowMissingColumns=True)


def _place(spark: SparkSession, path: str) -> tuple[str, str]:
    """A table of a run's folder, or else a folder of its own with one table."""
    root, _, table = path.rstrip("/").rpartition("/")
    return (root, table) if table in snapshots.snapshot(spark, root).tables else (path, "data")


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A table written as deltas, null columns where older ones lack them. None while nothing has
    been published."""
    return snapshots.read(spark, *_place(spark, path))


def upsert_parquet(
    batch: DataFrame, path: str, keys: Sequence[str], *, by: Sequence[str] = (),
    lookup: Sequence[str] = (), run: str | None = None, reset: bool = False,
) -> None:
    """Upsert ``batch`` (one row per key) into the table at ``path`` as a delta of its own.

    Only the batch's rows are written; running it again changes nothing that a reader sees.
    ``reset`` starts from empty.
    """
    spark = batch.sparkSession
    root, table = _place(spark, path)
    run = run or f"batch-{snapshots.snapshot(spark, root).number}"
    delta = snapshots.write_delta(batch, root, table, run=run, keys=keys, by=by, lookup=lookup)
    snapshots.publish(spark, root, [delta], run=run, reset=reset)
    snapshots.fold(spark, root, table)


def append_errors(errors: DataFrame, path: str, *, run_id: str, reset: bool = False) -> None:
    """Dead letters of one run or batch; writing them again replaces them."""
    spark = errors.sparkSession
    root, table = _place(spark, path)
    delta = snapshots.write_delta(error_delta(errors, run_id), root, table, run=run_id)
    snapshots.publish(spark, root, [delta], run=run_id, reset=reset)


def error_delta(errors: DataFrame, run_id: str) -> DataFrame:
    return errors.select(*ERROR_COLUMNS, F.lit(run_id).alias("run"))


def error_log(spark: SparkSession, path: str) -> DataFrame:
    """The dead letters of all runs and batches."""
    found = read_table(spark, path)
    if found is not None:
        return found
    return spark.createDataFrame(
        [], "file_path string, clinic_id string, stage string, reason string, detail string, "
            "occurred_at timestamp, run string")


def audit_rows(documents: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per document: the raw body and its two identities beside its standardised rows, in order.

    The rows gathered into one array all come from one file, whose text a single task has
    parsed already.
    """
    cols = [c for c in rows.columns if c not in ("path_parts", "file_path", "clinic_id")]
    per_file = rows.groupBy("file_path").agg(
        F.array_sort(F.collect_list(F.struct(
            "block_ord", "row_ord", "sub_ord",
            *[c for c in cols if c not in ("block_ord", "row_ord", "sub_ord")]))).alias("rows")
    )
    return documents.select(
        F.coalesce("document_id", "file_path").alias("document_id"), "clinic_id",
        "file_path", F.col("body").alias("raw"), "dedup_key", "content_hash",
    ).join(per_file.hint("merge"), "file_path", "left").withColumnRenamed("file_path", "source_file")
