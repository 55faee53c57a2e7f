"""Report files to documents: path-derived columns, tolerant parsing, error routing."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from labweave.functions.hashing import document_key, payload_hash
from labweave.functions.json_paths import pairs_to_map, path_text, shape_ok
from labweave.functions.text import _col
from labweave.sources.config import known_paths

ERROR_COLUMNS = ["file_path", "clinic_id", "stage", "reason", "detail", "occurred_at"]


def qualified(spark: SparkSession, path: str) -> str:
    """The path as the file reader reports it: with scheme and authority, no closing slash."""
    jvm = spark.sparkContext._jvm
    raw = jvm.org.apache.hadoop.fs.Path(path)
    fs = raw.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(raw).toString().rstrip("/")


def _below(path: Column, root: str) -> Column:
    """The part of ``path`` under ``root``; a path outside it fails the job."""
    start = root.rstrip("/") + "/"
    return F.when(
        F.startswith(path, F.lit(start)), F.substring(path, F.lit(len(start) + 1), F.length(path))
    ).otherwise(F.raise_error(F.concat(path, F.lit(f" is not below {start}"))))


def split_path(path: Column | str, root: str) -> list[Column]:
    """``clinic_id``, ``date_str`` and the sortable ``path_parts`` of one file path, which begins
    with ``root`` to the letter."""
    parts = F.split(_below(_col(path), root), "/")
    n = F.size(parts)
    return [
        F.when(n >= 2, F.get(parts, F.lit(0))).otherwise("unknown-clinic").alias("clinic_id"),
        F.when(n >= 3, F.get(parts, F.lit(1))).otherwise("unknown-date").alias("date_str"),
        parts.alias("path_parts"),
    ]


def read_files(
    spark: SparkSession, root: str, *, stream: bool = False, clinics: Sequence[str] = (),
    dates: Sequence[str] = (), folders: Sequence[str] = (), **options,
) -> DataFrame:
    """``clinic_id, date_str, path_parts, file_path, content`` of every ``*.json`` under root.

    ``clinics`` and ``dates`` leave all other folders unlisted, and so do ``folders``, full paths
    below root as :func:`qualified` writes them.
    """
    root = qualified(spark, root)
    reader = spark.readStream if stream else spark.read
    if stream:
        reader = reader.schema("path string, modificationTime timestamp, length long, content binary")
    raw = (
        reader.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .options(**options)
        .load([_no_glob(f) for f in folders] if folders else f"{root}{_folders(clinics, dates)}")
    )
    return raw.select(*split_path("path", root), F.col("path").alias("file_path"), "content")


def _no_glob(path: str) -> str:
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _folders(clinics: Sequence[str], dates: Sequence[str]) -> str:
    one_of = lambda names: "{" + ",".join(names) + "}" if names else "*"
    return (f"/{one_of(clinics)}" + (f"/{one_of(dates)}" if dates else "")) if clinics or dates else ""


def error_rows(df: DataFrame, stage: Column | str, reason: Column | str, detail: Column | None) -> DataFrame:
    """Dead-letter rows from anything with ``file_path`` and ``clinic_id``."""
    as_col = lambda c: F.lit(c) if isinstance(c, str) else c
    return df.select(
        "file_path", "clinic_id", as_col(stage).alias("stage"), as_col(reason).alias("reason"),
        (F.lit("") if detail is None else detail).alias("detail"),
        F.current_timestamp().alias("occurred_at"),
    )


def _valid_utf8(text: Column) -> Column:
    """``is_valid_utf8``, which goes over the bytes uncompiled, only for texts that need it: a text that
    decodes without the character put in place of bad bytes has none."""
    return F.when(F.rlike(text, F.lit("\ufffd")), F.is_valid_utf8(text)).when(
        text.isNotNull(), True)


def parse_documents(files: DataFrame, clinic: DataFrame) -> DataFrame:
    """One row per file with its parsed body, keys and failure reason.

    ``files`` holds ``clinic_id, date_str, path_parts, file_path`` and ``content`` (binary or
    text). ``reason`` is null for a usable document; good and failed files are two filters
    over this one plan.
    """
    paths = known_paths(clinic)
    text = F.col("content").cast("string")
    readable = _valid_utf8(text)
    known = files.join(clinic.withColumn("known", F.lit(True)), "clinic_id", "left")
    parsed = known.select(
        "*",
        F.when(F.col("known") & readable, F.try_parse_json(text)).alias("body"),
        readable.alias("readable"),
    )
    reason = (
        F.when(F.col("known").isNull(), "unknown_clinic")
        .when(~F.col("readable"), "unreadable_file")
        .when(F.col("body").isNull(), "malformed_json")
    )
    hashed = parsed.select(
        "clinic_id", "date_str", "path_parts", "file_path", "body", "source_system",
        reason.alias("reason"),
        F.when(F.col("body").isNotNull(), shape_ok("body", "required_keys")).alias("shape_ok"),
        path_text("body", "trace_path", known=paths["trace_path"]).alias("trace_id"),
        path_text("body", "document_path", known=paths["document_path"]).alias("document_id"),
        path_text("body", "correlation_path", known=paths["correlation_path"]).alias("correlation_id"),
        pairs_to_map("body", "meta_path", known=paths["meta_path"]).alias("meta"),
        payload_hash("body", "blocks_path", known=paths["blocks_path"]).alias("content_hash"),
        F.current_timestamp().alias("ingested_at"),
        "key_paths",
    )
    return hashed.select(
        "*", document_key("body", "key_paths", F.col("content_hash"), known=paths["key_paths"]).alias(
            "dedup_key")
    ).drop("key_paths")


def good_documents(parsed: DataFrame) -> DataFrame:
    return parsed.filter("reason is null").drop("reason")


def file_errors(parsed: DataFrame) -> DataFrame:
    detail = F.when(
        F.col("reason") == "unknown_clinic",
        F.concat(F.lit("no layout configured for '"), F.col("clinic_id"), F.lit("'")),
    ).when(F.col("reason") == "malformed_json", F.lit("not valid JSON")).otherwise(
        F.lit("not valid UTF-8")
    )
    return error_rows(parsed.filter("reason is not null"), "ingestion", F.col("reason"), detail)
