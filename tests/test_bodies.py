"""Bodies are looked into by paths parsed once, and landed whole."""

import glob
import json

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from checks import queries
from labweave.functions.json_paths import json_path, path_text
from labweave.operators import dedup
from labweave.session import checkpoint, shared_dir
from labweave.sources.config import KNOWN_PATHS, clinics_from_json, known_paths
from labweave.sources.files import parse_documents


def layouts(spark, *document_paths):
    rows = [(f"c{i:03d}.json", json.dumps({
        "envelope": {"document_id_path": p, "blocks_path": "leaves"}, "dedup_key_fields": ["document_id", "no"],
    })) for i, p in enumerate(document_paths)]
    return clinics_from_json(spark.createDataFrame(rows, "file_name string, text string"))


def files(spark, bodies):
    return spark.createDataFrame(
        [(c, "2024-01-01", [c, "2024-01-01", f"{i}.json"], f"/{i}.json", json.dumps(b))
         for i, (c, b) in enumerate(bodies)],
        "clinic_id string, date_str string, path_parts array<string>, file_path string, content string")


BODY = {"id": "x", "a": {"b": "deep"}, "it's": "quoted", "no": 7, "leaves": [1, 2]}


def test_known_paths_change_no_value(spark):
    df = spark.createDataFrame(
        [(p,) for p in ("id", "a.b", "zz", "no", None)], "p string").select(
        json_path("p").alias("p"), F.parse_json(F.lit(json.dumps(BODY))).alias("v"))
    for known in ([], ["$['id']"], ["$['zz']", "$['a']['b']", "$['id']"]):
        found = df.select(path_text("v", "p", known=known).alias("t")).collect()
        assert [r["t"] for r in found] == ["x", "deep", None, "7", None]


def test_layouts_paths_are_parsed_once(spark):
    clinic = layouts(spark, "id", "a.b")
    assert known_paths(clinic)["document_path"] == ["$['a']['b']", "$['id']"]
    assert known_paths(clinic)["key_paths"] == ["$['a']['b']", "$['id']", "$['no']"]
    assert known_paths(clinic)["trace_path"] == []
    docs = parse_documents(files(spark, [("c000", BODY), ("c001", BODY)]), clinic)
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert "$['a']['b']" in plan and "$['leaves']" in plan
    assert [r["document_id"] for r in docs.orderBy("clinic_id").collect()] == ["x", "deep"]


def test_many_layouts_go_by_the_rows_path(spark):
    names = [f"n{i}" for i in range(KNOWN_PATHS + 1)]
    clinic = layouts(spark, *names)
    assert known_paths(clinic)["document_path"] == []
    docs = parse_documents(files(spark, [("c003", {"n3": "third"})]), clinic)
    assert docs.first()["document_id"] == "third"


def test_a_quote_in_one_layouts_path_leaves_the_others_files_alone(spark):
    clinic = layouts(spark, "id", "it's")
    assert known_paths(clinic)["document_path"] == ["$['id']"]
    assert parse_documents(files(spark, [("c000", BODY)]), clinic).first()["document_id"] == "x"


def test_bodies_are_landed_whole(spark):
    docs = spark.range(500).select(F.parse_json(F.lit(json.dumps(BODY))).alias("body"))
    landed = checkpoint(docs, "whole-bodies")
    part = glob.glob(f"{shared_dir(spark)}/labweave/whole-bodies-*/part-*.parquet")[0]
    assert "typed_value" not in str(pq.ParquetFile(part).schema)
    assert landed.select(F.to_json("body").alias("t")).distinct().count() == 1


def test_a_long_list_of_copies_sorts_no_bodies(spark, monkeypatch):
    docs = spark.range(100).select(
        F.array(F.lpad(F.col("id").cast("string"), 3, "0")).alias("path_parts"),
        (F.col("id") % 60).cast("string").alias("dedup_key"), F.col("id").cast("string").alias("content_hash"),
        F.parse_json(F.lit("{}")).alias("body"))
    monkeypatch.setattr(dedup, "fits_broadcast", lambda df: False)
    kept, dropped = dedup.split_by_kept(docs, docs.filter("path_parts[0] < '060'"), "path_parts")
    assert (kept.count(), dropped.count()) == (60, 40)
    text = kept._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in text and "SortMergeJoin" not in text


def test_suppressed_files_make_no_rows(spark, tmp_path, monkeypatch):
    """The list of copies had waited for the standardising of every report."""
    spark.range(400).selectExpr(
        "id AS event_id", "timestamp'2024-01-01' + make_interval(0, 0, 0, 0, id) AS ts", "id % 9 AS user_id",
        "'view' AS event_type", "cast(id AS double) AS value", "'{}' AS props",
    ).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(queries.pipeline, "standardise", lambda *a, **o: 1 / 0)
    got = {r["file_path"].rsplit("/", 1)[1] for r in queries.QUERIES["suppressed_files"](spark, str(tmp_path)).collect()}
    known = [n for n in range(100) if n % 5 < 4]
    cut = {n for n in known if n % 11 == 0}  # a file cut short leaves no keys, so its copies stay
    want = {f"{n:010d}_b.json" for n in known if n % 7 == 0 and n % 5 < 2 and n not in cut}
    assert got == want | {f"{n:010d}_c.json" for n in known if n % 13 == 0 and n not in cut}
