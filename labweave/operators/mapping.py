"""Documents to rows: every field is looked up by the path its source's layout declares."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from labweave.functions.dates import parse_date
from labweave.functions.json_paths import (
    field_path, flatten_value, is_object, members, path_text, path_value,
)
from labweave.functions.numbers import split_composite
from labweave.functions.people import parse_age, parse_gender
from labweave.functions.text import clean
from labweave.operators.matching import match_medicines
from labweave.session import checkpoint, in_parts
from labweave.sources.config import known_paths
from labweave.sources.files import error_rows

LINEAGE = [
    "document_id", "correlation_id", "trace_id", "clinic_id", "date_str", "source_system",
    "source_system_reported", "claim_no", "nt_code", "consumer_client_id",
    "destination_identifier", "file_path", "ingested_at", "metadetails",
]
ORDER = ["path_parts", "block_ord", "row_ord", "sub_ord"]
# Paths by layout column (known_paths), which lookups then parse once.
Paths = Mapping[str, Sequence[str]]
NO_PATHS: Paths = {}
# Pair-list keys kept as columns.
META_KEYS = {
    "source_system_reported": "source_system", "claim_no": "claim_no", "nt_code": "nt_code",
    "consumer_client_id": "ConsumerClientId", "destination_identifier": "DestinationIdentifier",
}


def _mapped_value(members_: str, mapping: str, field: str) -> Column:
    """The member that the layout maps ``field`` to, null when it maps to none. Looking names
    up in a members map spares parsing a path per field and row."""
    name = F.try_element_at(F.col(mapping), F.lit(field))
    return F.try_element_at(F.col(members_), name)


def _mapped(members_: str, mapping: str, field: str) -> Column:
    return _mapped_value(members_, mapping, field).cast("string")


def add_lineage(docs: DataFrame) -> DataFrame:
    """Identity and pair-list columns carried by every row of a document."""
    meta = {c: F.try_element_at("meta", F.lit(k)) for c, k in META_KEYS.items()}
    return docs.withColumns(meta | {
        "metadetails": F.when(F.size("meta") > 0, F.to_json("meta")),
    })


def explode_blocks(docs: DataFrame, clinic: DataFrame) -> DataFrame:
    """One row per block with its ``record_type`` (null when the classifier is unknown).

    A layout without a blocks path has one block, the body, of its default type. Where the path
    leads to something that is not a list, that is one block no branch takes.
    """
    known = known_paths(clinic)
    d = docs.drop("source_system").join(clinic, "clinic_id")
    nothing = F.array().cast("array<variant>")
    at = path_value("body", "blocks_path", known=known["blocks_path"])
    # The list as a column of its own, so that each body is taken apart once.
    d = d.withColumn(
        "_list", path_value("body", "blocks_path", "array<variant>", known=known["blocks_path"]))
    blocks = F.when(
        F.col("blocks_path").isNotNull(),
        F.coalesce(
            "_list", F.when(at.isNotNull() & ~F.is_variant_null(at), F.array(at)), nothing),
    ).otherwise(F.array("body"))
    listed = F.col("blocks_path").isNull() | F.col("_list").isNotNull()
    b = d.select(
        "*", listed.alias("listed"), F.posexplode(blocks).alias("block_ord", "block")
    ).drop("body", "_list")
    found = path_text("block", field_path("type_field"), known=known["type_field"])
    kind = F.when(
        F.col("blocks_path").isNotNull(), F.try_element_at("type_map", found)
    ).otherwise(F.coalesce(F.try_element_at("type_map", F.lit("default")), F.lit("lab_report")))
    return b.withColumns({
        "classifier": found,
        "block_ok": F.col("blocks_path").isNull() | (F.col("listed") & is_object("block")),
        "record_type": kind,
    })


def land_blocks(blocks: DataFrame, clinic: DataFrame) -> DataFrame:
    """Blocks written once by record type, so that each branch reads its own kind only; the
    layout columns are joined again rather than stored."""
    own = [*LINEAGE, "path_parts", "block_ord", "block", "classifier", "listed", "block_ok",
           "record_type"]
    landed = checkpoint(blocks.select(*own), "blocks", by="record_type")
    return landed.join(clinic.drop("source_system"), "clinic_id")


def block_errors(blocks: DataFrame) -> DataFrame:
    """Dead letters of blocks that no branch takes."""
    rt = F.col("record_type")
    missing_spec = ((rt == "lab_report") & ~F.col("has_lab")) | (
        (rt == "discharge_summary") & ~F.col("has_discharge"))
    unhandled = ~rt.isin("lab_report", "discharge_summary")
    reason = (
        F.when(~F.col("listed"), F.lit("blocks_are_not_a_list"))
        .when(~F.col("block_ok"), F.lit("block_is_not_an_object"))
        .when(rt.isNull(), F.lit("unknown_classifier"))
        .when(missing_spec, F.concat(F.lit("no_"), rt, F.lit("_spec_for_clinic")))
        .when(unhandled, F.concat(F.lit("unhandled_record_type_"), rt))
    )
    bad = blocks.select("file_path", "clinic_id", "classifier", "record_type",
                        reason.alias("why"), missing_spec.alias("no_spec"))
    bad = bad.filter("why is not null")
    return error_rows(
        bad,
        F.when(F.col("no_spec"), F.col("record_type")).otherwise(F.lit("block_routing")),
        F.col("why"),
        F.when(F.col("why") == "unknown_classifier", F.concat(
            F.lit("classifier='"), F.coalesce("classifier", F.lit("None")), F.lit("'"))
        ).otherwise(F.lit("")),
    )


def _root(path: str, known: Paths) -> Column:
    """The object at the layout's path below the block; the block itself where there is none.
    A value that is not an object has no members, so its fields come out null."""
    at = path_value("block", path, known=known.get(path, ()))
    return F.when(F.col(path).isNotNull(), F.coalesce(at, F.col("block"))).otherwise(F.col("block"))


AGE_FIELDS = ["age_text", "age_years", "age_months", "age_days"]


def _declared_date(column: str) -> Column:
    return parse_date(column, F.col("date_pattern"), F.col("date_shape"))


def demographics(blocks: DataFrame, known: Paths = NO_PATHS) -> DataFrame:
    """Patient and report columns of lab blocks."""
    b = blocks.withColumn("demo", members(_root("demo_path", known)))
    # Raw texts first, as columns of their own, so that the parsers look each up once.
    texts = ["patient_name", "uhid", "gender", "hospital_name", "bill_date", "reports_date", "age"]
    b = b.withColumns({f: _mapped("demo", "demo_map", f) for f in texts} | {
        "lab_or_hospital_name": F.try_element_at(
            "demo", F.lit("lab_or_hospital_name")).cast("string"),
    })
    b = b.withColumns({
        "report_date": F.col("reports_date"),
        "gender": in_parts(parse_gender("gender")),
        "bill_date": _declared_date("bill_date"),
        "reports_date": _declared_date("reports_date"),
        "age": parse_age("age"),
    })
    return b.withColumns({f: F.col(f"age.{f}") for f in AGE_FIELDS}).drop("demo", "age")


DEMOGRAPHICS = [
    "patient_name", "uhid", "gender", "hospital_name", "lab_or_hospital_name", "bill_date",
    "reports_date", "report_date", "age_text", "age_years", "age_months", "age_days",
]


def test_rows(blocks: DataFrame, known: Paths = NO_PATHS) -> DataFrame:
    """Raw test rows of lab blocks: placeholder, non-object and nameless rows are left out and
    composite results become one row per part."""
    lab = blocks.filter("block_ok and record_type = 'lab_report' and has_lab")
    b = demographics(lab, known)
    rows = b.select(
        *LINEAGE, "path_parts", "block_ord", *DEMOGRAPHICS, "row_map", "skip_map",
        F.posexplode(path_value(
            "block", "rows_path", "array<variant>", known=known.get("rows_path", ())
        )).alias("row_ord", "row"),
    )
    rows = rows.withColumn("row", members("row")).filter("row is not null")
    is_placeholder = F.coalesce(
        (F.size("skip_map") > 0) & F.forall(
            F.map_entries("skip_map"),
            lambda e: F.coalesce(
                F.try_element_at("row", e["key"]).cast("string") == e["value"], F.lit(False)),
        ),
        F.lit(False),
    )
    text = lambda f: _mapped("row", "row_map", f)
    rows = rows.filter(~is_placeholder).withColumns({
        "row_name": text("test_name"),
        "row_result": text("result_text"),
        "unit_original": text("unit_original"),
        "range_text": text("range_text"),
        "page_number": text("page_number"),
    }).filter(clean("row_name") != "").drop("row", "row_map", "skip_map")
    return explode_composites(rows, "row_name", "row_result")


def explode_composites(rows: DataFrame, name: str, result: str) -> DataFrame:
    """Add ``sub_ord, test_name_original, result_text, result_text_original``: the parts of a
    composite result as rows of their own, anything else as it is."""
    itself = F.array(F.struct(F.col(name).alias("name"), F.col(result).alias("value")))
    parts = F.coalesce(split_composite(result), itself)
    return rows.select(
        "*", F.posexplode(parts).alias("sub_ord", "part")
    ).select(
        *[c for c in rows.columns if c not in (name, result)], "sub_ord",
        F.col("part.name").alias("test_name_original"),
        F.col("part.value").alias("result_text"),
        F.col(result).alias("result_text_original"),
        F.col("range_text").alias("range_text_original"),
    )


SUMMARY_TEXTS = [
    "hospital_address", "doctor_name", "ward", "diagnosis", "brief_history",
    "general_examinations", "course_during_hospitalisation", "recommendations",
    "post_discharge_advice", "medicine_injections_investigation",
]


def _discharge_blocks(blocks: DataFrame, known: Paths) -> DataFrame:
    dis = blocks.filter("block_ok and record_type = 'discharge_summary' and has_discharge")
    return dis.withColumn("root", members(_root("dis_path", known)))


def discharge_rows(blocks: DataFrame, known: Paths = NO_PATHS) -> DataFrame:
    """One summary row per discharge block; list-valued fields become one text."""
    b = _discharge_blocks(blocks, known)
    texts = ["patient_name", "gender", "hospital_name", "admission_date", "discharge_date", "age"]
    b = b.withColumns({f: _mapped("root", "dis_map", f) for f in texts})
    b = b.withColumns({
        "gender": parse_gender("gender"),
        "admission_date": _declared_date("admission_date"),
        "discharge_date": _declared_date("discharge_date"),
        "age": parse_age("age"),
        **{f: flatten_value(_mapped_value("root", "dis_map", f)) for f in SUMMARY_TEXTS},
    })
    out = b.withColumns({f: F.col(f"age.{f}") for f in AGE_FIELDS} | {
        "record_type": F.lit("discharge_summary"), "row_ord": F.lit(-1), "sub_ord": F.lit(0),
        "other_med_inj_investigations": F.col("medicine_injections_investigation"),
    })
    return out.select(
        *LINEAGE, *ORDER, "record_type", "patient_name", "gender", "hospital_name",
        "admission_date", "discharge_date", "age_text", "age_years", "age_months", "age_days",
        *SUMMARY_TEXTS, "other_med_inj_investigations",
    )


def medication_rows(blocks: DataFrame, medicine: DataFrame, known: Paths = NO_PATHS) -> DataFrame:
    """One row per discharge medication, resolved to its generic name."""
    b = _discharge_blocks(blocks, known).select(
        *LINEAGE, "path_parts", "block_ord", "med_map",
        _mapped("root", "dis_map", "patient_name").alias("patient_name"),
        F.posexplode(path_value(
            "block", "meds_path", "array<variant>", known=known.get("meds_path", ())
        )).alias("row_ord", "row"),
    )
    b = b.withColumn("row", members("row")).filter("row is not null").withColumns({
        "record_type": F.lit("medication"), "sub_ord": F.lit(0),
        "medicine": _mapped("row", "med_map", "medicine"),
        "dose": _mapped("row", "med_map", "dose"),
        "frequency": _mapped("row", "med_map", "frequency"),
    }).drop("row", "med_map")
    m = match_medicines(b, "medicine", medicine)
    return m.withColumns({
        "medication_name": F.col("medicine"), "medication_medicine": F.col("medicine"),
        "discharge_medications_medicine": F.col("medicine"),
        "medication_dose": F.col("dose"), "discharge_medications_dose": F.col("dose"),
        "medication_frequency": F.col("frequency"),
        "discharge_medications_frequency": F.col("frequency"),
    })
