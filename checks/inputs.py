"""Inputs the queries share: messy rows and nested report files derived from the tables.

Column expressions are plain SQL text that both engines read, so both sides start from the
same rows.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from labweave.session import configure
from labweave.sources.config import Dims, clinics_from_json, make_dims
from labweave.sources.files import split_path

ROOT = "/landing"

# ord, canonical name, value type, unit, aliases
TESTS = [
    (0, "Page View", "numeric", "mg/dL", ["view", "page views"]),
    (1, "Error", "numeric", "mg/dL", ["errors", "error"]),
    (2, "Signup", "numeric", "g/L", ["sign up", "signup"]),
    (3, "Purchase", "numeric", None, ["purchase", "purchases total"]),
    (4, "Click", "text", None, ["click", "clicks"]),
    (5, "Click", "numeric", "mg/dL", ["click through"]),
]
# canonical name, low, high, outlier low, outlier high
RANGES = [
    ("Page View", 20.0, 100.0, 1.0, 300.0),
    ("Error", 5.0, 40.0, 0.5, 200.0),
    ("Signup", 10.0, 100.0, 0.0, 400.0),
    ("Click", 1.0, 50.0, 0.0, 1000.0),
]
# spelling, canonical unit, factor
UNITS = [
    ("mg/dl", "mg/dL", 1.0), ("mg/dL", "mg/dL", 1.0), ("g/l", "g/L", 1.0),
    ("K/uL", "cells", 1000.0), ("dg/dl", "mg/dL", 100.0), ("", None, 1.0),
]
# ord, generic name, drug class, brands
MEDICINES = [
    (0, "Brand", "class a", ["Economy brand", "Small"]),
    (1, "Standard", "class b", ["Medium", "Large 10 mg tab"]),
    (2, "Promo", "class c", ["Promo plus"]),
]

RAW = {
    "event_id": "event_id",
    "doc": "user_id",
    "page": "CAST(event_id % 4 AS INT)",
    "ts": "ts",
    "raw_name": """CASE event_id % 6 WHEN 0 THEN event_type WHEN 1 THEN upper(event_type)
        WHEN 2 THEN concat(event_type, ' (note)') WHEN 3 THEN substring(event_type, 2)
        WHEN 4 THEN substring(event_type, 1, length(event_type) - 1)
        ELSE concat('xyz ', event_type, ' 123') END""",
    "result": """CASE event_id % 9 WHEN 0 THEN CAST(value AS STRING)
        WHEN 1 THEN concat('H ', CAST(value AS STRING))
        WHEN 2 THEN concat(CAST(value AS STRING), ' mg/dl') WHEN 3 THEN 'BLURRED'
        WHEN 4 THEN '31-44' WHEN 5 THEN '' WHEN 6 THEN concat(' ', CAST(value AS STRING), ' ')
        WHEN 7 THEN 'view - 1.5, error - 25.5' ELSE '1:80' END""",
    "unit": """CASE event_id % 5 WHEN 0 THEN 'mg/dl' WHEN 1 THEN 'MG/DL ' WHEN 2 THEN 'g/l'
        WHEN 3 THEN 'weird' ELSE '' END""",
    "range_text": """CASE event_id % 3 WHEN 0 THEN '0-100' WHEN 1 THEN ' 50 - 150.5'
        ELSE 'n/a' END""",
}
# Placeholder rows, and a value that every third document states on two pages.
FILE_NAME = """CASE WHEN event_id % 40 = 7 THEN 'test_name'
    WHEN event_id % 12 IN (1, 3) THEN 'View' ELSE raw_name END"""
FILE_RESULT = """CASE WHEN event_id % 40 = 7 THEN 'result'
    WHEN event_id % 12 IN (1, 3) THEN '55.5' ELSE result END"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf}/{name}.parquet")


def raw_results(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(*[f"{e} AS {n}" for n, e in RAW.items()])


def _literal(v) -> str:
    if v is None:
        return "CAST(NULL AS STRING)"
    if isinstance(v, list):
        return "array(" + ", ".join(_literal(x) for x in v) + ")"
    if isinstance(v, float):
        return f"CAST({v} AS DOUBLE)"
    return repr(v) if isinstance(v, int) else "'" + v + "'"


def values_table(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    body = ", ".join("(" + ", ".join(_literal(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({names})")


# Three source layouts, invented here: a wrapper of typed leaves, a sheet with everything at the
# top level (names with blanks), and a deep tree whose rows have dotted names.
ALPHA = {
    "source_system": "alpha_v1", "date_format": "%d/%m/%Y",
    "match": {"strategy": "envelope_shape", "required_keys": ["wrap", "no"]},
    "envelope": {
        "trace_id_path": "no", "document_id_path": "wrap.paper.id",
        "correlation_id_path": "wrap.paper.series", "meta_details_path": "wrap.notes",
        "blocks_path": "wrap.leaves.list", "record_type_field": "of",
        "record_type_map": {"bench": "lab_report", "ward": "discharge_summary"}},
    "lab_report": {
        "basic_info_path": "subject",
        "demographics_field_map": {
            "uhid": "nr", "age": "lived", "gender": "kind", "patient_name": "label",
            "hospital_name": "place", "bill_date": "charged", "reports_date": "closed"},
        "rows_path": "grid.cells",
        "row_field_map": {"test_name": "item", "result_text": "got", "unit_original": "as",
                          "range_text": "span", "page_number": "pg"},
        "skip_rows_where": {"item": "test_name", "got": "result"}},
    "discharge_summary": {
        "root_path": "case",
        "field_map": {"patient_name": "label", "age": "lived", "gender": "kind",
                      "admission_date": "opened", "discharge_date": "ended",
                      "diagnosis": "story", "medicine_injections_investigation": "used"},
        "medications_path": "case.pack",
        "medication_field_map": {"medicine": "ware", "dose": "count", "frequency": "rhythm"}},
    "dedup_key_fields": ["document_id", "correlation_id"],
}
BETA = {
    "source_system": "beta_v1", "date_format": "%Y-%m-%d",
    "match": {"strategy": "envelope_shape", "required_keys": ["Sheet Id", "Lines"]},
    "envelope": {"trace_id_path": "Sheet Id", "document_id_path": "Sheet Id",
                 "correlation_id_path": "Tour", "record_type_map": {"default": "lab_report"}},
    "lab_report": {
        "demographics_field_map": {"uhid": "Nr", "age": "Lived", "gender": "Kind",
                                   "patient_name": "Full Label", "bill_date": "Charged On",
                                   "reports_date": "Closed On"},
        "rows_path": "Lines",
        "row_field_map": {"test_name": "Item", "result_text": "Got", "unit_original": "As",
                          "range_text": "From - To"},
        "skip_rows_where": {}},
    "dedup_key_fields": ["document_id"],
}
GAMMA = {
    "source_system": "gamma_v1", "date_format": "%m/%d/%Y",
    "match": {"strategy": "envelope_shape", "required_keys": ["tree"]},
    "envelope": {"trace_id_path": "tree.root.run", "document_id_path": "tree.root.nr",
                 "correlation_id_path": "tree.root.tour",
                 "record_type_map": {"default": "lab_report"}},
    "lab_report": {
        "basic_info_path": "tree.root.who",
        "demographics_field_map": {"uhid": "who.nr", "age": "who.lived", "gender": "who.kind",
                                   "patient_name": "who.label", "bill_date": "day.in",
                                   "reports_date": "day.out"},
        "rows_path": "tree.stem.leaves",
        "row_field_map": {"test_name": "leaf.item", "result_text": "leaf.got",
                          "unit_original": "leaf.as", "range_text": "leaf.span",
                          "page_number": "leaf.pg"},
        "skip_rows_where": {}},
    "dedup_key_fields": ["document_id", "correlation_id"],
}

_DIMS: dict[str, Dims] = {}


def dims(spark: SparkSession) -> Dims:
    """The dictionaries of one session, measured once."""
    app = spark.sparkContext.applicationId
    if app not in _DIMS:
        configure(spark)
        configs = values_table(
            spark,
            [(f"{n}.json", json.dumps(c)) for n, c in
             (("alpha", ALPHA), ("beta", BETA), ("gamma", GAMMA))],
            "file_name, text")
        _DIMS.clear()
        _DIMS[app] = make_dims(
            tests=values_table(spark, TESTS, "ord, canonical_name, value_type, unit_canonical, aliases"),
            ranges=values_table(spark, RANGES, "canonical, low, high, outlier_low, outlier_high"),
            units=values_table(spark, UNITS, "unit_key, canonical, factor"),
            medicines=values_table(spark, MEDICINES, "ord, generic_name, drug_class, brand_names"),
            clinics=clinics_from_json(configs),
        )
    return _DIMS[app]


def report_files(spark: SparkSession, sf: str) -> DataFrame:
    """Nested report files made from events: four events make one document, so a document
    has a fixed size however many events a user has.

    Documents are spread over three known sources and an unknown one; some are cut short,
    some come again under new ids (``_b``) or with the same ids and other content (``_c``).
    """
    rows = raw_results(spark, sf).withColumn("doc_no", F.floor(F.col("event_id") / 4))
    rows = rows.withColumns({"raw_name": F.expr(FILE_NAME), "result": F.expr(FILE_RESULT)})
    alpha_row = F.struct(F.col("page").alias("pg"), F.col("range_text").alias("span"),
                         F.col("result").alias("got"), F.col("raw_name").alias("item"),
                         F.col("unit").alias("as"))
    beta_row = F.struct(F.col("raw_name").alias("Item"), F.col("result").alias("Got"),
                        F.col("unit").alias("As"), F.col("range_text").alias("From - To"))
    gamma_row = F.struct(F.col("raw_name").alias("leaf.item"), F.col("result").alias("leaf.got"),
                         F.col("unit").alias("leaf.as"), F.col("range_text").alias("leaf.span"),
                         F.col("page").alias("leaf.pg"))
    doc = rows.groupBy("doc_no").agg(
        F.min("ts").alias("ts"),
        F.array_sort(F.collect_list(F.struct(
            "event_id", alpha_row.alias("a"), beta_row.alias("b"), gamma_row.alias("g"),
        ))).alias("rows"),
    )
    kinds = F.array_compact(F.array(
        F.lit("a"),
        F.when((F.col("doc_no") % 7 == 0) & (F.col("doc_no") % 5 < 2), "b"),
        F.when(F.col("doc_no") % 13 == 0, "c"),
    ))
    doc = doc.withColumn("kind", F.explode(kinds)).withColumns({
        "clinic": F.element_at(
            F.array(*[F.lit(c) for c in ("alpha", "alpha", "beta", "gamma", "omega")]),
            (F.col("doc_no") % 5 + 1).cast("int")),
        # New ids for a content copy, another patient for an id copy.
        "ids": F.concat(F.col("doc_no").cast("string"), F.when(F.col("kind") == "b", "-again")
                        .otherwise("")),
        "patient": F.concat(F.when(F.col("kind") == "c", "K").otherwise("U"), "doc_no"),
    })
    day = lambda f: F.date_format("ts", f)

    def named(prefix: str, c: str, name: str):
        return F.concat(F.lit(prefix), F.col(c)).alias(name)

    info = F.struct(
        F.col("patient").alias("nr"),
        F.concat((F.col("doc_no") % 90).cast("string"), F.lit("Y2M")).alias("lived"),
        F.lit("M").alias("kind"), named("P ", "patient", "label"),
        F.lit("Lab").alias("place"), day("dd/MM/yyyy").alias("charged"),
        day("d-MMM-yyyy").alias("closed"))
    lab = F.to_json(F.struct(
        F.lit("bench").alias("of"), info.alias("subject"),
        F.struct(F.transform("rows", lambda r: r["a"]).alias("cells")).alias("grid")))
    med = lambda name, dose: F.struct(
        name.alias("ware"), F.lit(dose).alias("count"), F.lit("BD").alias("rhythm"))
    discharge = F.to_json(F.struct(F.lit("ward").alias("of"), F.struct(
        named("P ", "patient", "label"), F.lit("[AGE REDACTED]").alias("lived"),
        F.lit("female").alias("kind"), day("dd.MM.yyyy").alias("opened"),
        F.lit("soon").alias("ended"), named("case ", "doc_no", "story"),
        F.array(F.lit("INJ A"), F.concat(F.lit("INJ "), F.col("doc_no"))).alias("used"),
        F.array(med(F.lit("Tab. Medium 5 mg"), "1"), med(F.lit("Standard"), "2"),
                med(F.concat(F.lit("Unknown "), F.col("doc_no")), "3")).alias("pack"),
    ).alias("case")))
    other = F.to_json(F.struct(F.lit("scan").alias("of"), F.lit(1).alias("pixels")))
    blocks = F.array_join(F.array_compact(F.array(
        lab, F.when(F.col("doc_no") % 6 == 0, discharge), F.when(F.col("doc_no") % 9 == 0, other),
    )), ",")
    meta = F.to_json(F.array(*[
        F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in (
            ("claim_no", F.lit("old")), ("source_system", F.lit("FAST")),
            ("claim_no", F.concat(F.lit("CL-"), F.col("doc_no"))))]))
    alpha = F.concat(
        F.lit('{"no":"T-'), F.col("ids"), F.lit('","wrap":{"paper":{"id":"D-'), F.col("ids"),
        F.lit('","series":"C-'), F.col("ids"), F.lit('"},"notes":'), meta,
        F.lit(',"leaves":{"list":['), blocks, F.lit("]}}}"))
    beta = F.to_json(F.struct(
        named("D-", "ids", "Sheet Id"), named("V-", "ids", "Tour"), F.col("patient").alias("Nr"),
        (F.col("doc_no") % 90).alias("Lived"), F.lit("Female").alias("Kind"),
        named("P ", "patient", "Full Label"), day("yyyy-MM-dd").alias("Charged On"),
        F.lit("N/A").alias("Closed On"), F.transform("rows", lambda r: r["b"]).alias("Lines")))
    gamma = F.to_json(F.struct(F.struct(
        F.struct(
            named("T-", "ids", "run"), named("D-", "ids", "nr"), named("V-", "ids", "tour"),
            F.struct(F.col("patient").alias("who.nr"), F.lit("unknown").alias("who.kind"),
                     named("P ", "patient", "who.label"), day("MM/dd/yyyy").alias("day.in"),
                     day("dd.MM.yyyy").alias("day.out")).alias("who")).alias("root"),
        F.struct(F.transform("rows", lambda r: r["g"]).alias("leaves")).alias("stem"),
    ).alias("tree")))
    body = F.when(F.col("clinic") == "beta", beta).when(F.col("clinic") == "gamma", gamma).otherwise(alpha)
    cut = (F.col("doc_no") % 11 == 0) & (F.col("kind") == "a")
    path = F.concat(
        F.lit(f"{ROOT}/"), F.col("clinic"), F.lit("/"), day("yyyy-MM-dd"), F.lit("/"),
        F.lpad(F.col("doc_no").cast("string"), 10, "0"), F.lit("_"), F.col("kind"), F.lit(".json"))
    files = doc.select(
        path.alias("file_path"),
        F.when(cut, F.left(body, F.length(body) - 1)).otherwise(body).alias("content"))
    return files.select(*split_path("file_path", ROOT), "file_path", "content")
