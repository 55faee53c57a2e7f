"""One query per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.inputs import dims, raw_results, report_files, table
from labweave import functions as fn
from labweave.operators import dedup, mapping, matching, measures, sinks, sketches, snapshots, stats
from labweave.plans import pipeline, reports
from labweave.plans.replay import replay_files
from labweave.session import checkpoint, scratch_path
from labweave.sources.config import Dims, alias_pool, small
from labweave.sources.files import parse_documents
from labweave.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _spread(df: DataFrame, col: str, *fields: str) -> DataFrame:
    return df.select("*", *[F.col(f"{col}.{f}").alias(f) for f in fields]).drop(col)


# ---- scalar transforms ----------------------------------------------------------------


@query
def parse_numeric(spark, sf):
    df = fn.with_number(raw_results(spark, sf).select("event_id", "result"), "result", "n")
    return _spread(df.drop("result"), "n", "value", "flag", "residual_unit", "is_numeric", "contradictory", "raw")


@query
def parse_range(spark, sf):
    df = raw_results(spark, sf).select("event_id", fn.parse_range("range_text").alias("r"))
    return _spread(df, "r", "low", "high")


@query
def split_composite(spark, sf):
    df = raw_results(spark, sf).select(
        "event_id", F.posexplode(fn.split_composite("result")).alias("part_no", "p"))
    return _spread(df, "p", "name", "value")


@query
def composite_explode(spark, sf):
    """Composite results become rows of their own and keep unit, range and page."""
    rows = raw_results(spark, sf)
    out = mapping.explode_composites(rows, "raw_name", "result")
    return out.select("event_id", "sub_ord", "test_name_original", "result_text",
                      "result_text_original", "unit", "range_text", "page")


AGE = """CASE event_id % 7 WHEN 0 THEN CAST(event_id % 100 AS STRING) WHEN 1 THEN '33Y11M265D'
    WHEN 2 THEN concat(CAST(event_id % 90 AS STRING), 'Y') WHEN 3 THEN '[AGE REDACTED]'
    WHEN 4 THEN '45 years' WHEN 5 THEN ' 7.5 ' ELSE 'adult' END"""


@query
def parse_age(spark, sf):
    df = table(spark, sf, "events").selectExpr("event_id", f"{AGE} AS age_raw")
    df = df.select("event_id", fn.parse_age("age_raw").alias("a"))
    return _spread(df, "a", "age_text", "age_years", "age_months", "age_days")


GENDER = """CASE c_custkey % 7 WHEN 0 THEN 'M' WHEN 1 THEN 'female' WHEN 2 THEN ' Man '
    WHEN 3 THEN '[GENDER REDACTED]' WHEN 4 THEN '' WHEN 5 THEN 'not said' ELSE 'TRANS' END"""


@query
def normalise_gender(spark, sf):
    return table(spark, sf, "customer").selectExpr("c_custkey", f"{GENDER} AS g").select(
        "c_custkey", fn.parse_gender("g").alias("gender"))


@query
def parse_date(spark, sf):
    d = F.col("o_orderdate")
    k = F.col("o_orderkey") % 9
    formats = ["dd/MM/yyyy", "MM/dd/yyyy", "yyyy-MM-dd", "d-M-yyyy", "dd.MM.yyyy",
               "dd-MMM-yyyy", "d/MMM/yyyy", "dd-MMMM-yyyy"]
    text = F.lit("31/02/1999")
    for i, f in enumerate(formats):
        text = F.when(k == i, F.date_format(d, f)).otherwise(text)
    declared = F.when(F.col("o_orderkey") % 2 == 0, "%d/%m/%Y").otherwise("%m/%d/%Y")
    return table(spark, sf, "orders").select(
        "o_orderkey", fn.parse_date(text, fn.spark_date_pattern(declared)).alias("parsed"))


DECORATED = """CASE p_partkey % 4 WHEN 0 THEN upper(p_name) WHEN 1 THEN concat(p_name, ' (', p_brand, ')')
    WHEN 2 THEN replace(p_name, ' ', ' - ') ELSE concat('  ', p_name, '!, ', p_type, '+') END"""


@query
def normalise_name(spark, sf):
    return table(spark, sf, "part").selectExpr("p_partkey", f"{DECORATED} AS t").select(
        "p_partkey", fn.normalise_name("t").alias("name_norm"))


@query
def normalise_text(spark, sf):
    """The name normaliser over whole documents."""
    return table(spark, sf, "documents").select("doc_id", fn.normalise_name("text").alias("norm"))


@query
def display_values(spark, sf):
    """Result and range as shown, from one cent to above ten million."""
    value = F.col("l_extendedprice") * 1000
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        fn.result_text(F.when(F.col("l_linenumber") % 3 != 0, value), "l_returnflag").alias("shown"),
        fn.range_text("l_quantity", F.when(F.col("l_linenumber") % 2 == 0, value),
                      "l_linestatus").alias("range_shown"))


@query
def row_id(spark, sf):
    return raw_results(spark, sf).select(
        "event_id", fn.row_id(["doc", F.lit("lab_test"), "raw_name",
                               F.nullif("result", F.lit("")), "unit"]).alias("id"))


@query
def content_hash(spark, sf):
    """Payload hash of a JSON body; page numbers do not count, at any depth."""
    body = F.to_json(F.struct(
        F.col("source"), F.col("lang"), F.col("doc_id").alias("page_no"),
        F.struct(F.col("n_chars").alias("n"), F.concat(F.lit("p"), "doc_id").alias("page_no"),
                 F.struct("text", F.col("doc_id").alias("page_no")).alias("body"))
        .alias("inner")))
    docs = table(spark, sf, "documents").select("doc_id", F.parse_json(body).alias("body"))
    return docs.select("doc_id", fn.payload_hash("body", F.lit(None).cast("string")).alias("hash"))


@query
def document_key(spark, sf):
    """Identity hash over the declared fields that are present, else the fallback."""
    body = F.to_json(F.struct(
        F.when(F.col("doc_id") % 3 != 0, F.col("source")).alias("source"),
        F.struct(F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("lang")).alias("m")))
    docs = table(spark, sf, "documents").select(
        "doc_id", F.parse_json(body).alias("body"),
        F.array(fn.json_path(F.lit("source")), fn.json_path(F.lit("m.lang"))).alias("paths"))
    return docs.select("doc_id", fn.document_key("body", "paths", F.lit("none")).alias("key"))


@query
def severity_classes(spark, sf):
    rows = _classified(spark, sf)
    return rows.select("event_id", fn.severity_rank("status").alias("severity"),
                       fn.display_class("status").alias("display_class"))


# ---- JSON mapping ---------------------------------------------------------------------


@query
def path_extract(spark, sf):
    """Paths held in a column: one plan reads whichever member each row names."""
    df = table(spark, sf, "events").select(
        "event_id", F.try_parse_json(F.concat(
            F.lit('{"outer":{"in ner":'), F.col("props"), F.lit(',"nil":null}}'))).alias("v"),
        F.element_at(F.array(F.lit("outer.in ner.k"), F.lit("outer.nil"), F.lit("outer.none.k"),
                             F.lit("outer.in ner")), (F.col("event_id") % 4 + 1).cast("int")).alias("p"))
    at = fn.path_value("v", fn.json_path("p"))
    return df.select("event_id", fn.path_text("v", fn.json_path("p")).alias("found"),
                     at.isNotNull().alias("present"))


@query
def meta_map(spark, sf):
    """Key/value pair lists to columns; the last of equal keys wins."""
    pairs = F.to_json(F.array(*[
        F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in (
            ("claim_no", F.lit("old")), ("nt_code", F.col("c_mktsegment")),
            ("claim_no", F.col("c_name")))]))
    df = table(spark, sf, "customer").select(
        "c_custkey", F.parse_json(F.concat(
            F.lit('{"m":'), F.left(pairs, F.length(pairs) - 1), F.lit(',{"value":"no key"}]}'),
        )).alias("v"))
    m = fn.pairs_to_map("v", F.lit("$['m']"))
    return df.select("c_custkey", F.size(m).alias("n"), m["claim_no"].alias("claim_no"),
                     m["nt_code"].alias("nt_code"))


@query
def flatten_values(spark, sf):
    """Lists to one text, objects to JSON, scalars as they are, empty list to null."""
    text = F.when(F.col("doc_id") % 4 == 0, F.to_json(F.array("source", "lang"))).when(
        F.col("doc_id") % 4 == 1, F.to_json(F.struct("source"))).when(
        F.col("doc_id") % 4 == 2, F.lit("[]")).otherwise(F.col("n_chars").cast("string"))
    return table(spark, sf, "documents").select(
        "doc_id", fn.flatten_value(F.parse_json(text)).alias("flat"))


@query
def malformed_json(spark, sf):
    """Broken bodies go aside, good ones go on."""
    body = F.when(F.col("event_id") % 7 == 0, F.left("props", F.length("props") - 1)).otherwise(
        F.col("props"))
    v = F.try_parse_json(body)
    return table(spark, sf, "events").select(
        "event_id", F.when(v.isNull(), "malformed_json").alias("reason"),
        fn.path_value(v, F.lit("$['k']"), "bigint").alias("k"))


@query
def shape_check(spark, sf):
    """Required top-level keys; a null value counts as present."""
    body = F.when(F.col("event_id") % 3 == 0, F.lit('{"j":1}')).when(
        F.col("event_id") % 3 == 1, F.lit('{"k":null,"j":2}')).otherwise(F.col("props"))
    return table(spark, sf, "events").select(
        "event_id", fn.shape_ok(F.parse_json(body), F.array(F.lit("k"))).alias("shape_ok"))


@query
def unknown_source(spark, sf):
    """Documents of a source without a configuration, beside those that go on."""
    known = small(table(spark, sf, "documents").select("source").distinct().filter(
        "length(source) = 4"))
    docs = table(spark, sf, "documents").select("doc_id", "source")
    gone = docs.join(known, "source", "left_anti").withColumn("reason", F.lit("unknown_clinic"))
    return docs.join(known, "source").withColumn("reason", F.lit(None).cast("string")).unionByName(gone)


def _blocks(spark, sf) -> DataFrame:
    d = dims(spark)
    parsed = parse_documents(report_files(spark, sf), d.clinic)
    return mapping.explode_blocks(
        mapping.add_lineage(parsed.filter("reason is null").drop("reason")), d.clinic)


@query
def scan_paths(spark, sf):
    """Source, date and ids of every file, from its path and its body."""
    return parse_documents(report_files(spark, sf), dims(spark).clinic).select(
        "file_path", "clinic_id", "date_str", "reason", "document_id", "correlation_id",
        "trace_id", "shape_ok")


@query
def route_blocks(spark, sf):
    b = _blocks(spark, sf)
    return b.groupBy("clinic_id", "record_type", "classifier").agg(F.count("*").alias("n"))


@query
def block_dead_letters(spark, sf):
    e = mapping.block_errors(_blocks(spark, sf))
    return e.select("file_path", "clinic_id", "stage", "reason", "detail")


@query
def map_demographics(spark, sf):
    lab = _blocks(spark, sf).filter("record_type = 'lab_report'")
    return mapping.demographics(lab).select(
        "file_path", "patient_name", "uhid", "gender", "hospital_name", "bill_date",
        "reports_date", "age_text", "age_years", "age_months", "claim_no",
        "source_system_reported")


@query
def map_test_rows(spark, sf):
    """Rows of every layout in one shape, placeholders left out, composites split."""
    return mapping.test_rows(_blocks(spark, sf)).select(
        "file_path", "row_ord", "sub_ord", "test_name_original", "result_text", "unit_original",
        "range_text", "page_number")


@query
def map_discharge(spark, sf):
    return mapping.discharge_rows(_blocks(spark, sf)).select(
        "file_path", "patient_name", "gender", "admission_date", "discharge_date", "diagnosis",
        "medicine_injections_investigation", "age_text", "age_years")


@query
def map_medications(spark, sf):
    return mapping.medication_rows(_blocks(spark, sf), dims(spark).medicine).select(
        "file_path", "row_ord", "medicine", "generic_name", "drug_class", "medicine_type", "dose",
        "frequency")


# ---- matching -------------------------------------------------------------------------

CUT_NAME = """CASE p_partkey % 8 WHEN 0 THEN p_name WHEN 1 THEN substring(p_name, 2)
    WHEN 2 THEN substring(p_name, 1, length(p_name) - 1) WHEN 3 THEN replace(p_name, 'l', 'i')
    WHEN 4 THEN substring(p_name, 3) WHEN 5 THEN substring(p_name, 1, length(p_name) - 3)
    WHEN 6 THEN concat(upper(p_name), ' (', p_brand, ')') ELSE concat(p_name, 's') END"""


def _part_names(spark, sf) -> DataFrame:
    return table(spark, sf, "part").selectExpr("p_partkey", f"{CUT_NAME} AS raw_name")


def _part_dims(spark, sf) -> Dims:
    d = dims(spark)
    names = table(spark, sf, "part").groupBy("p_name").agg(F.min("p_partkey").alias("ord"))
    tests = names.select(
        "ord", F.col("p_name").alias("canonical_name"), F.lit("numeric").alias("value_type"),
        F.lit(None).cast("string").alias("unit_canonical"),
        F.array(F.concat("p_name", F.lit(" unit"))).alias("aliases"))
    return Dims(alias=small(alias_pool(tests), hint=False), test=d.test, unit=d.unit, medicine=d.medicine)


@query
def match_exact(spark, sf):
    names = matching.distinct_names(_part_names(spark, sf), "raw_name")
    return matching.exact_matches(names, _part_dims(spark, sf).alias)


@query
def match_suffix(spark, sf):
    names = matching.distinct_names(_part_names(spark, sf), "raw_name")
    return matching.suffix_matches(names, _part_dims(spark, sf).alias)


@query
def match_prefix(spark, sf):
    names = matching.distinct_names(_part_names(spark, sf), "raw_name")
    return matching.prefix_matches(names, _part_dims(spark, sf).alias)


@query
def match_similar_ratio(spark, sf):
    """Best alias by exact Ratcliff-Obershelp ratio, for every distinct name."""
    names = matching.distinct_names(_part_names(spark, sf), "raw_name")
    return matching.similar_matches(names, _part_dims(spark, sf).alias).select(
        "name_norm", "alias_norm", "canonical", F.round("score", 6).alias("score"), "confidence")


@query
def match_similar_levenshtein(spark, sf):
    """Best alias by edit distance, for every distinct name, in built-in functions alone."""
    names = matching.distinct_names(_part_names(spark, sf), "raw_name")
    return matching.edit_matches(names, _part_dims(spark, sf).alias).select(
        "name_norm", "alias_norm", "canonical", "distance", F.round("score", 6).alias("score"))


@query
def match_tiered(spark, sf):
    """Every row resolved by the first tier that answers."""
    out = matching.match_names(_part_names(spark, sf), "raw_name", _part_dims(spark, sf),
                               spread=["p_partkey"])
    return out.select("p_partkey", "canonical", "method", "confidence")


MEDICINE_TEXT = """CASE p_partkey % 6 WHEN 0 THEN p_type WHEN 1 THEN concat('Tab. ', p_type, ' 500 mg')
    WHEN 2 THEN p_brand WHEN 3 THEN concat(p_type, ' 10mg capsule') WHEN 4 THEN concat('Inj ', p_brand)
    ELSE '' END"""


@query
def medicine_map(spark, sf):
    df = table(spark, sf, "part").selectExpr("p_partkey", f"{MEDICINE_TEXT} AS medicine")
    return matching.match_medicines(df, "medicine", dims(spark).medicine)


# ---- units, ranges, classification ----------------------------------------------------


def _named(spark, sf) -> DataFrame:
    rows = raw_results(spark, sf).withColumnRenamed("result", "result_text")
    rows = rows.withColumnRenamed("unit", "unit_original")
    return matching.match_names(rows, "raw_name", dims(spark), spread=["event_id"])


def _classified(spark, sf, **options) -> DataFrame:
    return measures.measure(_named(spark, sf), dims(spark), **options)


@query
def test_attributes(spark, sf):
    """Expected unit and value type by canonical name; the last dictionary entry counts."""
    return _named(spark, sf).join(dims(spark).test, "canonical", "left").select(
        "event_id", "canonical", "unit_expected", "value_type")


@query
def unit_convert(spark, sf):
    return _classified(spark, sf).select("event_id", "result_value", "unit_canonical")


@query
def range_fallback(spark, sf):
    return _classified(spark, sf).select("event_id", "range_low", "range_high", "range_source")


@query
def classify(spark, sf):
    return _classified(spark, sf).select("event_id", "status", "exclude")


@query
def classify_reported(spark, sf):
    """The converted value against the report's own range where it has one."""
    return _classified(spark, sf, compare_on="converted", range_from="reported_first").select(
        "event_id", "status")


@query
def excluded_rows(spark, sf):
    return _classified(spark, sf).filter("exclude").select(
        "event_id", "canonical", "unit_canonical", "reason")


@query
def status_breakdown(spark, sf):
    """Rows per result status, largest first."""
    rows = _classified(spark, sf).filter("not exclude")
    return stats.breakdown(rows.select(F.col("status").alias("test_analytics")),
                           "test_analytics", nulls=False)


# ---- dedup ----------------------------------------------------------------------------


def _resubmissions(spark, sf) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id", F.concat_ws("-", "source", "n_chars").alias("dedup_key"),
        F.sha2("text", 256).alias("content_hash"))


@query
def file_dedup_first_round(spark, sf):
    return dedup.first_round_kept(_resubmissions(spark, sf), order="doc_id").select("doc_id")


@query
def file_dedup_greedy(spark, sf):
    """Kept documents of the greedy pass; a dropped document's keys are not remembered."""
    return dedup.greedy_kept(_resubmissions(spark, sf), order="doc_id").select("doc_id")


def _dense(spark, sf) -> DataFrame:
    """Few keys and few contents, so that chains of drops occur."""
    return table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("k"), F.col("o_custkey")).alias("dedup_key"),
        F.concat(F.lit("h"), F.col("o_custkey") % 50, F.lit("-"),
                 F.floor(F.col("o_totalprice") / 20000)).alias("content_hash"))


@query
def file_dedup_chains(spark, sf):
    return dedup.greedy_kept(_dense(spark, sf), order="o_orderkey").select("o_orderkey")


@query
def repeat_flag(spark, sf):
    rows = raw_results(spark, sf).withColumn("note", F.lit(None).cast("string"))
    out = dedup.flag_repeats(rows, ["doc", "raw_name", "result"], ["event_id"], page="page",
                             reason="note", flag="repeated")
    return out.select("event_id", "repeated", "note")


@query
def keep_first(spark, sf):
    lines = table(spark, sf, "lineitem")
    return dedup.keep_first(
        lines, ["l_orderkey", "l_linenumber"],
        ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"],
    ).select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey")


@query
def latest_per_key(spark, sf):
    orders = table(spark, sf, "orders")
    return dedup.keep_last(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_orderdate")


# ---- sinks ----------------------------------------------------------------------------


def _order_halves(spark, sf) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    first = o.filter("o_orderkey % 3 != 0 or o_orderkey % 2 = 1")
    later = o.filter("o_orderkey % 2 = 0").withColumns({
        "o_totalprice": F.col("o_totalprice") + 1, "o_note": F.lit("later")})
    return first, later


@query
def upsert_merge(spark, sf):
    """A later batch replaces rows with its keys; its extra column is null elsewhere."""
    first, later = _order_halves(spark, sf)
    return sinks.upsert(first, later, ["o_orderkey"]).select(
        "o_orderkey", "o_custkey", F.round("o_totalprice", 2).alias("o_totalprice"), "o_note")


@query
def upsert_table(spark, sf):
    """The same through deltas that are merged on reading, the second batch loaded twice."""
    path = scratch_path(spark, "upsert")
    first, later = _order_halves(spark, sf)
    for batch in (first, later, later):
        sinks.upsert_parquet(batch, path, ["o_orderkey"])
    return sinks.read_table(spark, path).select(
        "o_orderkey", "o_custkey", F.round("o_totalprice", 2).alias("o_totalprice"), "o_note")


@query
def reset_table(spark, sf):
    """A table started again from empty holds the last batch alone."""
    path = scratch_path(spark, "reset")
    first, later = _order_halves(spark, sf)
    sinks.upsert_parquet(first, path, ["o_orderkey"])
    for _ in range(2):
        sinks.upsert_parquet(later, path, ["o_orderkey"], reset=True)
    return sinks.read_table(spark, path).select(
        "o_orderkey", "o_custkey", F.round("o_totalprice", 2).alias("o_totalprice"), "o_note")


@query
def error_log_tail(spark, sf):
    """Dead letters written as JSON lines and read back, the last ten newest first."""
    path = scratch_path(spark, "dead-letter")
    bad = table(spark, sf, "events").filter("event_type = 'error'").select(
        F.concat(F.lit("f"), F.col("event_id")).alias("file_path"),
        F.concat(F.lit("c"), F.col("user_id")).alias("clinic_id"), F.lit("ingestion").alias("stage"),
        F.lit("malformed_json").alias("reason"), F.lit("").alias("detail"),
        F.date_trunc("second", "ts").alias("occurred_at"))
    for _ in range(2):  # a repeated run replaces its letters
        sinks.append_errors(bad, path, run_id="run-1")
    return reports.recent_errors(sinks.error_log(spark, path)).select(
        "file_path", "clinic_id", "occurred_at")


# ---- the whole pipeline ---------------------------------------------------------------

_FILES: dict[tuple[str, str], DataFrame] = {}


def _files(spark, sf) -> DataFrame:
    """The report files, landed for queries that read them more than once."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FILES:
        _FILES[key] = checkpoint(report_files(spark, sf), "files")
    return _FILES[key]


_DOCUMENTS: dict[tuple[str, str], pipeline.Documents] = {}
_RUNS: dict[tuple[str, str], pipeline.RunResult] = {}


def _documents(spark, sf) -> pipeline.Documents:
    """The run's files, parsed and relieved of copies."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _DOCUMENTS:
        files = _FILES[key] if key in _FILES else report_files(spark, sf)
        _DOCUMENTS[key] = pipeline.read_documents(files, dims(spark))
    return _DOCUMENTS[key]


def _run(spark, sf) -> pipeline.RunResult:
    """The batch run over the nested files; its landed tables serve every query on it."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _RUNS:
        _RUNS[key] = pipeline.process(_documents(spark, sf), dims(spark))
    return _RUNS[key]


def _records(spark, sf) -> DataFrame:
    return pipeline.load_rows(_run(spark, sf).rows)


_WRITTEN: dict[tuple[str, str], str] = {}


def _written(spark, sf) -> str:
    """Folder of the tables of that run, published as one snapshot."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _WRITTEN:
        out = scratch_path(spark, "tables")
        pipeline.write_result(_run(spark, sf), out)
        _WRITTEN[key] = out
    return _WRITTEN[key]


STORED = [
    "file_path", "id", "document_id", "clinic_id", "record_type", "patient_name",
    "test_name_canonical", "test_name_original", "result_value", "result_text",
    "unit_canonical", "range_low", "range_high", "range_source", "test_analytics",
    "normalization_method", "duplicate_within_report", "page_number", "medicine",
    "generic_name", "claim_no", "reports_date",
]


@query
def stored_records(spark, sf):
    """Files to stored rows: parse, suppress, map, match, measure, flag, collapse by id."""
    result = pipeline.process(report_files(spark, sf), dims(spark))
    return pipeline.load_rows(result.rows).select(*STORED)


@query
def suppressed_files(spark, sf):
    """Copies among the documents, known before any row of a report is made."""
    return dedup.suppressed_rows(_documents(spark, sf).dropped).select("file_path", "clinic_id", "reason")


@query
def dead_letters(spark, sf):
    e = _run(spark, sf).errors
    return e.groupBy("file_path", "clinic_id", "stage", "reason").agg(F.count("*").alias("n"))


@query
def clinic_stats(spark, sf):
    return reports.clinic_quality(_run(spark, sf).stats)


@query
def stats_upsert(spark, sf):
    """Statistics by source written twice and read back: still a row per source."""
    path = scratch_path(spark, "stats")
    for _ in range(2):
        sinks.upsert_parquet(_run(spark, sf).stats, path, ["clinic_id"])
    return sinks.read_table(spark, path)


@query
def run_log(spark, sf):
    """The run's log row written twice under one run id and read back."""
    path = scratch_path(spark, "runs")
    log = checkpoint(pipeline.run_log(_run(spark, sf)), "run-log")  # counted once
    for _ in range(2):
        sinks.upsert_parquet(log, path, ["run_id"])
    return sinks.read_table(spark, path).drop("run_id", "started_at", "finished_at")


@query
def run_summary(spark, sf):
    return _run(spark, sf).summary


@query
def unresolved_names(spark, sf):
    return stats.unresolved_names(_run(spark, sf).rows)


@query
def unresolved_rate(spark, sf):
    rows = _run(spark, sf).rows.filter("record_type = 'lab_test'")
    return stats.unresolved_rate(rows, F.col("date_str").cast("date")).select(
        "clinic_id", "day", "n", F.round("unresolved_rate", 6).alias("unresolved_rate"))


def _within(estimates: DataFrame, rows: DataFrame) -> DataFrame:
    """Exact counts per source, and whether the estimates keep to their stated error."""
    lab = rows.filter("record_type = 'lab_test'").select(
        "clinic_id", "document_id", "test_name_original", "result_value")
    median = F.col("e.median")
    exact = lab.alias("r").join(F.broadcast(estimates.alias("e")), "clinic_id").groupBy("clinic_id").agg(
        F.count("*").alias("n"), F.countDistinct("document_id").alias("documents"),
        F.countDistinct("test_name_original").alias("test_names"),
        F.first("e.documents").alias("d"), F.first("e.test_names").alias("t"), F.first("rows").alias("rows"),
        F.avg((F.col("result_value") < median).cast("int")).alias("below"),
        F.avg((F.col("result_value") <= median).cast("int")).alias("up_to"))
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= sketches.DISTINCT_ERROR * F.col(b)
    return exact.select(
        "clinic_id", "n", "documents", "test_names",
        (near("d", "documents") & near("t", "test_names") & (F.col("rows") == F.col("n"))).alias(
            "counts_within"),
        ((F.col("below") <= 0.5 + sketches.RANK_ERROR)
         & (F.col("up_to") >= 0.5 - sketches.RANK_ERROR)).alias("median_within"))


@query
def quality_sketches(spark, sf):
    """Day sketches merged by source, held against exact counts."""
    rows = _run(spark, sf).rows
    days = sketches.day_sketches(rows)
    return _within(sketches.read_sketches(sketches.merge_sketches(days, "clinic_id")), rows)


@query
def streamed_quality(spark, sf):
    """The same sketches from two micro-batches, read from the stream's table."""
    return _within(pipeline.stored_quality(spark, _streamed(spark, sf), "clinic_id"), _run(spark, sf).rows)


@query
def error_rate_daily(spark, sf):
    files = scan_paths(spark, sf)
    out = stats.error_rate(files, F.col("date_str").cast("date"), alert_above=0.01)
    return out.select("day", "seen", "failed", F.round("error_rate", 6).alias("error_rate"))


@query
def five_column_view(spark, sf):
    return reports.five_column_view(_records(spark, sf))


@query
def flagged_queue(spark, sf):
    """The review queue in severity order; ids break ties."""
    return reports.flagged_queue(_records(spark, sf)).select(
        "id", "document_id", "test_analytics", "duplicate_within_report", "result_value")


@query
def flagged_queue_filtered(spark, sf):
    return reports.flagged_queue(_records(spark, sf), flag="Outlier", clinic="alpha", limit=40).select(
        "id", "document_id", "test_analytics", "clinic_id")


@query
def flagged_queue_repeats(spark, sf):
    """Restated values, which equal ids would collapse on load, so ahead of it."""
    return reports.flagged_queue(_run(spark, sf).rows, flag="WithinReportDuplicate").select(
        "id", "document_id", "duplicate_within_report")


@query
def record_search(spark, sf):
    """Through the index of grams, built over the records of the published run."""
    path = scratch_path(spark, "search")
    reports.index_records(snapshots.read(spark, _written(spark, sf), "records"), path)
    return reports.indexed_search(spark, path, "p u1")


@query
def record_search_scan(spark, sf):
    """The same by a scan, as terms without a gram are answered."""
    return reports.record_search(_records(spark, sf), "p u1")


@query
def record_detail(spark, sf):
    """All rows of the largest document beside its raw body, looked up in the published tables."""
    records = snapshots.read(spark, _written(spark, sf), "records")
    audit = snapshots.read(spark, _written(spark, sf), "audit")
    top = records.groupBy("document_id").agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), "document_id").first()
    return reports.record_detail(records, audit, top["document_id"]).select(
        "document_id", "record_type", "page_number", "id",
        F.contains("raw_json", F.col("document_id")).alias("raw_found"))


@query
def audit_trail(spark, sf):
    """Documents beside the rows made from them."""
    run = _run(spark, sf)
    return sinks.audit_rows(run.documents, run.rows).select(
        "source_file", "clinic_id", "document_id", F.coalesce(F.size("rows"), F.lit(0)).alias("n_rows"),
        F.transform("rows", lambda r: r["test_name_original"])[0].alias("first_name"))


def _dashboard(spark, sf) -> dict[str, DataFrame]:
    run = _run(spark, sf)
    log = run.summary.select(F.lit(run.run_id).alias("run_id"),
                             F.current_timestamp().alias("finished_at"), "*")
    return reports.dashboard(_records(spark, sf), log, run.errors)


@query
def record_types(spark, sf):
    return _dashboard(spark, sf)["record_type_breakdown"]


@query
def dashboard_status(spark, sf):
    return _dashboard(spark, sf)["flagged_breakdown"]


@query
def dashboard_totals(spark, sf):
    parts = _dashboard(spark, sf)
    out = parts["total_records"].select(F.lit("records").alias("what"), "c")
    return out.unionByName(parts["error_count"].select(F.lit("errors").alias("what"), "c"))


@query
def latest_run(spark, sf):
    """The newest entry of a run log with one entry per order."""
    log = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("run_id"), F.col("o_orderdate").alias("finished_at"))
    return reports.latest_run(log)


@query
def clinic_list(spark, sf):
    return reports.clinic_list(_records(spark, sf))


@query
def repeated_values(spark, sf):
    return reports.repeated_values(_run(spark, sf).rows).select(
        "document_id", "test_name_canonical", "result_text", "page_number")


@query
def restatement_audit(spark, sf):
    """Equal results of one user on more than one page."""
    rows = raw_results(spark, sf).select(
        F.col("doc").alias("document_id"), F.col("raw_name").alias("test_name_canonical"),
        F.col("result").alias("result_text"), F.col("page").alias("page_number"))
    return reports.restatement_audit(rows)


# ---- streaming ------------------------------------------------------------------------


def _event_stream(spark, sf) -> DataFrame:
    schema = table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def _drain(df: DataFrame, mode: str, path: str) -> DataFrame:
    """Run a stream to the end of its input; each micro-batch lands as one folder, so a replay
    overwrites itself."""
    spark = df.sparkSession

    def land(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/out/batch_id={batch_id}")

    q = (
        df.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/state")
        .trigger(availableNow=True).foreachBatch(land).start()
    )
    q.awaitTermination()
    return spark.read.parquet(f"{path}/out")


_REPLAYS: dict[tuple[str, str], str] = {}


def _replayed(spark, sf) -> str:
    """Folder of the tables of a run that lacked one source's layout, after its replay with all."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _REPLAYS:
        out, files, all_dims = scratch_path(spark, "replayed"), _files(spark, sf), dims(spark)
        poor = replace(all_dims, clinic=all_dims.clinic.filter("clinic_id <> 'gamma'"))
        pipeline.write_result(pipeline.process(files, poor), out)
        replay_files(files, all_dims, out)
        _REPLAYS[key] = out
    return _REPLAYS[key]


@query
def replayed_records(spark, sf):
    """Records after the replay: those of a run that had all layouts at once."""
    return sinks.read_table(spark, f"{_replayed(spark, sf)}/records").select(*STORED)


@query
def replayed_letters(spark, sf):
    """Letters after the replay: what a run with all layouts leaves."""
    return sinks.error_log(spark, f"{_replayed(spark, sf)}/dead_letter").groupBy(
        "file_path", "clinic_id", "stage", "reason").agg(F.count("*").alias("n"))


@query
def replayed_stats(spark, sf):
    """Counts by source, the replay's differences added."""
    return pipeline.stored_stats(spark, _replayed(spark, sf))


@query
def streamed_counts(spark, sf):
    """Event types counted over a stream; the last state is the answer."""
    counts = _event_stream(spark, sf).groupBy("event_type").agg(F.count("*").alias("n"))
    landed = _drain(counts, "complete", scratch_path(spark, "stream"))
    return dedup.keep_last(landed, ["event_type"], ["batch_id"]).select("event_type", "n")


@query
def streamed_error_rate(spark, sf):
    """Failures per event-time hour, with a watermark for late events."""
    events = _event_stream(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    rates = ingest.rolling_error_rate(
        events, "ts", F.col("event_type") == "error", window="1 hour")
    landed = _drain(rates, "update", scratch_path(spark, "stream"))
    return dedup.keep_last(landed, ["window_start"], ["batch_id"]).select(
        "window_start", "seen", "failed", F.round("error_rate", 6).alias("error_rate"))


_STREAMS: dict[tuple[str, str], str] = {}


def _streamed(spark, sf) -> str:
    """Folder of the tables that a stream of two micro-batches wrote."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _STREAMS:
        _STREAMS[key] = _stream(spark, sf)
    return _STREAMS[key]


def _stream(spark, sf) -> str:
    base = scratch_path(spark, "ingest")
    files = _files(spark, sf)
    d = dims(spark)
    # The second arrival holds everything, so the first one's files come again.
    for part, arrived in enumerate((files.filter(F.col("path_parts")[2] < "0000001000"), files)):
        arrived.write.parquet(f"{base}/in/part={part}")
        stream = spark.readStream.schema(files.schema).option(
            "recursiveFileLookup", True).parquet(f"{base}/in")
        stream.writeStream.option("checkpointLocation", f"{base}/state").trigger(
            availableNow=True
        ).foreachBatch(
            lambda df, i: ingest.ingest_batch(df, i, d, f"{base}/out")
        ).start().awaitTermination()
    return f"{base}/out"


@query
def streamed_ingest(spark, sf):
    """Report files streamed in micro-batches; copies of anything kept before are suppressed
    and rows are upserted by id."""
    return sinks.read_table(spark, f"{_streamed(spark, sf)}/records").groupBy("clinic_id", "record_type").agg(
        F.count("*").alias("n"))


@query
def streamed_stats(spark, sf):
    """Statistics by source after two micro-batches, of which the second repeats the first's files."""
    return pipeline.stored_stats(spark, _streamed(spark, sf))


@query
def streamed_dead_letters(spark, sf):
    """Dead letters of both micro-batches: a bad file that comes again has one in each."""
    return sinks.error_log(spark, f"{_streamed(spark, sf)}/dead_letter").groupBy(
        "clinic_id", "stage", "reason").agg(F.count("*").alias("n"), F.countDistinct("run").alias("batches"))
