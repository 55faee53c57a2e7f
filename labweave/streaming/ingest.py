"""Continuous ingest with Structured Streaming.

Each micro-batch runs the batch plan and publishes its tables as one snapshot under its number, so
a batch that is replayed after a failure leaves the same tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from labweave.operators import sinks, snapshots
from labweave.operators.dedup import greedy_kept, placed, split_by_kept, suppressed_rows
from labweave.operators.stats import clinic_stats, run_summary
from labweave.plans.pipeline import (
    RunResult, loaded_ids, standardise, unresolved_errors, write_result,
)
from labweave.session import checkpoint, configure, scratch_scope
from labweave.sources.config import Dims
from labweave.sources.files import file_errors, good_documents, parse_documents, read_files


def kept_keys(spark: SparkSession, out: str) -> DataFrame | None:
    """``k, h`` of documents kept by the batches published so far."""
    seen = sinks.read_table(spark, f"{out}/kept_keys")
    return None if seen is None else seen.select("k", "h")


def ingest_batch(files: DataFrame, batch_id: int, dims: Dims, out: str, *, stream: str = "stream") -> None:
    """One micro-batch: parse, suppress copies of anything kept so far, standardise, and publish what
    a batch run writes, with the batch's kept keys, as one snapshot. A batch that was published before
    a failure is left as it is. Its scratch tables go at the end."""
    spark = files.sparkSession
    if batch_id <= snapshots.snapshot(spark, out).numbered.get(stream, -1):
        return
    started = spark.sql("select now()").first()[0]
    with scratch_scope(spark):
        parsed = checkpoint(parse_documents(files, dims.clinic), "documents")
        good = good_documents(placed(parsed))
        kept = checkpoint(greedy_kept(good, seen=kept_keys(spark, out)), "kept")
        docs, dropped = split_by_kept(good, kept, "path_parts")
        rows, errors = standardise(docs, dims)
        rows = checkpoint(rows, "rows")
        suppressed = suppressed_rows(dropped)
        write_result(RunResult(
            run_id=f"{stream}-{batch_id}", documents=docs, suppressed=suppressed, rows=rows,
            errors=file_errors(parsed).unionByName(errors).unionByName(unresolved_errors(rows)),
            stats=clinic_stats(parsed, suppressed, rows),
            summary=run_summary(parsed, suppressed, rows, loaded_ids(rows)),
        ), out, started=started, writer=stream, number=batch_id, more={"kept_keys": kept.select(
            F.col("dedup_key").alias("k"), F.col("content_hash").alias("h"))})


def start_ingest(
    spark: SparkSession, root: str, dims: Dims, out: str, *, checkpoint_location: str,
    files_per_trigger: int = 10_000, available_now: bool = True, interval: str = "1 minute",
) -> StreamingQuery:
    """Ingest files as they arrive under ``root``; ``available_now`` stops after those there."""
    configure(spark)
    files = read_files(spark, root, stream=True, maxFilesPerTrigger=files_per_trigger)
    writer = files.writeStream.option("checkpointLocation", checkpoint_location).foreachBatch(
        lambda df, batch_id: ingest_batch(df, batch_id, dims, out))
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def rolling_error_rate(
    events: DataFrame, ts: str, failed: Column, *, window: str = "1 hour",
    slide: str | None = None, late: str = "1 hour",
) -> DataFrame:
    """Share of failures per event-time window; late events up to ``late`` still count."""
    return (
        events.withWatermark(ts, late)
        .groupBy(F.window(ts, window, slide).alias("w"))
        .agg(F.count("*").alias("seen"), F.count_if(failed).alias("failed"))
        .select(
            F.col("w.start").alias("window_start"), "seen", "failed",
            (F.col("failed") / F.col("seen")).alias("error_rate"))
    )
