"""Dictionaries and source layouts as DataFrames.

Onboarding a source, alias, unit, range or brand is a new row here; no plan changes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from labweave.functions.dates import date_shape, spark_date_pattern
from labweave.functions.json_paths import field_path, json_path
from labweave.functions.text import normalise_medicine, normalise_name

BROADCAST_ROWS = 200_000
BROADCAST_CHARS = 64 * 1024 * 1024


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_chars: int = BROADCAST_CHARS
) -> bool:
    """Measure ``df`` against the broadcast bound, on no more rows than that takes."""
    rows, chars = df.limit(max_rows + 1).select(F.length(F.to_json(F.struct("*"))).alias("c")).agg(
        F.count("*"), F.coalesce(F.sum("c"), F.lit(0))
    ).first()
    return rows <= max_rows and chars <= max_chars


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Hint a broadcast only after measuring ``df``; a larger one is left to shuffle joins."""
    return F.broadcast(df) if fits_broadcast(df) else df


def measured(df: DataFrame, *, rows: int | None = None) -> DataFrame:
    """``df`` as the smaller side of a join: broadcast if it measures small, else never.

    Spark's own choice goes by compressed bytes, shared out evenly over a file's columns, so a column
    of ids or paths may take a hundred times that in the driver. ``rows``, if known, spares measuring
    a table that can't fit.
    """
    if rows is not None and rows > BROADCAST_ROWS or not fits_broadcast(df):
        return df.hint("merge")
    return F.broadcast(df)


def small(df: DataFrame, *, hint: bool = True) -> DataFrame:
    """:func:`broadcast_if_small` for dictionaries, kept in memory for their many uses.

    Without ``hint`` the joins go by the size in memory: for tables that are multiplied
    ahead of a join, where a hint would carry over to the larger result.
    """
    df = df.persist()
    if not fits_broadcast(df):
        return df.unpersist()
    return F.broadcast(df) if hint else df


#: Columns of a layout with one path each, and the most paths of a column that plans name.
PATHS = ["trace_path", "document_path", "correlation_path", "meta_path", "blocks_path", "demo_path",
         "rows_path", "dis_path", "meds_path"]
KNOWN_PATHS = 16
PLAIN_PATH = r"^\$(\['[^'\]]+'\])+$"


def known_paths(clinic: DataFrame) -> dict[str, list[str]]:
    """The layouts' distinct paths by column, for lookups that parse them once. A column with more than
    ``KNOWN_PATHS`` has none here, nor has a name with a quote, which as a fixed path would fail the
    files of all layouts: such lookups go by the row's value, as they can for any."""
    of = lambda c, path: F.struct(F.lit(c).alias("of"), path.alias("path"))
    flat = clinic.select(F.explode(F.concat(
        F.array(*[of(c, F.col(c)) for c in PATHS], of("type_field", field_path("type_field"))),
        F.transform("key_paths", lambda p: of("key_paths", p)))).alias("p")).select("p.*")
    found: dict[str, list[str]] = {c: [] for c in [*PATHS, "type_field", "key_paths"]}
    for r in flat.filter(F.rlike("path", F.lit(PLAIN_PATH))).distinct().limit(len(found) * KNOWN_PATHS + 1).collect():
        found[r["of"]].append(r["path"])
    return {c: sorted(p) if len(p) <= KNOWN_PATHS else [] for c, p in found.items()}


@dataclass(frozen=True)
class Dims:
    """Dictionary tables, broadcast-hinted (but for ``alias``) where their measured size allows.

    alias     alias_norm, canonical, pool_ord, first_canonical   one row per distinct alias
    test      canonical, unit_expected, value_type, cfg_low, cfg_high, outlier_low, outlier_high
    unit      unit_key, unit_to, factor
    medicine  med_norm, generic_name, drug_class, is_generic
    clinic    clinic_id and one column per layout property
    """

    alias: DataFrame
    test: DataFrame
    unit: DataFrame
    medicine: DataFrame
    clinic: DataFrame | None = None
    threshold: float = 0.9


def alias_pool(tests: DataFrame) -> DataFrame:
    """Every name a test goes by, normalised, with its place in the dictionary."""
    names = tests.select(
        "ord",
        "canonical_name",
        F.posexplode(
            F.concat(F.array("canonical_name"), F.coalesce("aliases", F.array().cast("array<string>")))
        ).alias("i", "alias"),
    ).select(
        normalise_name("alias").alias("alias_norm"),
        F.col("canonical_name").alias("canonical"),
        F.struct("ord", "i").alias("pool_ord"),
    )
    # An alias listed twice resolves to its last entry; first-wins tiers use its first place.
    return (
        names.filter("alias_norm != ''")
        .groupBy("alias_norm")
        .agg(
            F.max_by("canonical", "pool_ord").alias("canonical"),
            F.min("pool_ord").alias("pool_ord"),
            F.min_by("canonical", "pool_ord").alias("first_canonical"),
        )
    )


def make_dims(
    *,
    tests: DataFrame,
    ranges: DataFrame,
    units: DataFrame,
    medicines: DataFrame,
    clinics: DataFrame | None = None,
    threshold: float = 0.9,
) -> Dims:
    """Dictionaries from plain tables.

    tests      ord, canonical_name, value_type, unit_canonical, aliases array<string>
    ranges     canonical, low, high, outlier_low, outlier_high
    units      unit_key, canonical, factor
    medicines  ord, generic_name, drug_class, brand_names array<string>
    """
    test = tests.groupBy(F.col("canonical_name").alias("canonical")).agg(
        F.max_by("unit_canonical", "ord").alias("unit_expected"),
        F.max_by(F.coalesce("value_type", F.lit("text")), "ord").alias("value_type"),
    )
    range_ = ranges.select(
        "canonical",
        F.col("low").cast("double").alias("cfg_low"),
        F.col("high").cast("double").alias("cfg_high"),
        F.col("outlier_low").cast("double").alias("outlier_low"),
        F.col("outlier_high").cast("double").alias("outlier_high"),
    )
    unit = units.select(
        "unit_key",
        F.col("canonical").alias("unit_to"),
        F.coalesce(F.col("factor").cast("double"), F.lit(1.0)).alias("factor"),
    )
    # Within an entry the generic name comes after its brands, so it wins a tie.
    generic = normalise_medicine("generic_name")
    medicine = (
        medicines.select(
            "ord", "generic_name", "drug_class", generic.alias("generic_norm"),
            F.posexplode(
                F.concat(F.coalesce("brand_names", F.array().cast("array<string>")),
                         F.array("generic_name"))
            ).alias("i", "brand"),
        )
        .select("*", normalise_medicine("brand").alias("med_norm"))
        .groupBy("med_norm")
        .agg(F.max_by(
            F.struct("generic_name", "drug_class",
                     (F.col("med_norm") == F.col("generic_norm")).alias("is_generic")),
            F.struct("ord", "i")).alias("m"))
        .select("med_norm", "m.*")
    )
    return Dims(
        alias=small(alias_pool(tests), hint=False), test=small(test.join(range_, "canonical", "full")),
        unit=small(unit), medicine=small(medicine), clinic=None if clinics is None else small(clinics),
        threshold=threshold,
    )


_DICTIONARY = """_meta struct<fuzzy_threshold: double>,
  tests array<struct<canonical_name: string, value_type: string, unit_canonical: string,
                     aliases: array<string>>>"""
_RANGES = """ranges map<string, struct<low: double, high: double, outlier_low: double,
                                       outlier_high: double>>"""
_UNITS = "unit_aliases map<string, struct<canonical: string, factor: double>>"
_MEDICINES = """medicines array<struct<generic_name: string, drug_class: string,
                                       brand_names: array<string>>>"""
_CLINIC = """clinic_id string, source_system string, date_format string,
  match struct<strategy: string, required_keys: array<string>>,
  envelope struct<trace_id_path: string, document_id_path: string,
                  correlation_id_path: string, meta_details_path: string,
                  blocks_path: string, record_type_field: string,
                  record_type_map: map<string,string>>,
  lab_report struct<basic_info_path: string, demographics_field_map: map<string,string>,
                    rows_path: string, row_field_map: map<string,string>,
                    skip_rows_where: map<string,string>>,
  discharge_summary struct<root_path: string, field_map: map<string,string>,
                           medications_path: string,
                           medication_field_map: map<string,string>>,
  dedup_key_fields array<string>"""


def _whole(spark: SparkSession, path: str, schema: str, name: str = "*.json") -> DataFrame:
    text = spark.read.option("pathGlobFilter", name).text(path, wholetext=True)
    return text.select(
        F.col("_metadata.file_name").alias("file_name"),
        F.from_json("value", schema, {"mode": "FAILFAST"}).alias("c"),
    )


def clinics_from_files(configs: DataFrame) -> DataFrame:
    """Layout rows from ``(file_name, c struct)``; the file stem stands in for a missing id."""
    env, lab, dis = F.col("c.envelope"), F.col("c.lab_report"), F.col("c.discharge_summary")

    def id_path(f: Column) -> Column:
        dotted = F.when(f == "document_id", env["document_id_path"]).when(
            f == "correlation_id", env["correlation_id_path"]).otherwise(f)
        return json_path(dotted)

    shape_checked = F.col("c.match.strategy") == "envelope_shape"
    return (
        configs.select(
            F.coalesce(F.nullif("c.clinic_id", F.lit("")),
                       F.regexp_replace("file_name", r"\.json$", "")).alias("clinic_id"),
            "file_name",
            F.col("c.source_system").alias("source_system"),
            spark_date_pattern("c.date_format").alias("date_pattern"),
            date_shape("c.date_format").alias("date_shape"),
            F.when(shape_checked, F.coalesce("c.match.required_keys", F.array().cast("array<string>")))
            .otherwise(F.array().cast("array<string>")).alias("required_keys"),
            json_path(env["trace_id_path"]).alias("trace_path"),
            json_path(env["document_id_path"]).alias("document_path"),
            json_path(env["correlation_id_path"]).alias("correlation_path"),
            json_path(env["meta_details_path"]).alias("meta_path"),
            json_path(env["blocks_path"]).alias("blocks_path"),
            env["record_type_field"].alias("type_field"),
            env["record_type_map"].alias("type_map"),
            F.transform(F.coalesce("c.dedup_key_fields", F.array().cast("array<string>")),
                        id_path).alias("key_paths"),
            lab.isNotNull().alias("has_lab"),
            json_path(lab["basic_info_path"]).alias("demo_path"),
            lab["demographics_field_map"].alias("demo_map"),
            json_path(lab["rows_path"]).alias("rows_path"),
            lab["row_field_map"].alias("row_map"),
            lab["skip_rows_where"].alias("skip_map"),
            dis.isNotNull().alias("has_discharge"),
            json_path(dis["root_path"]).alias("dis_path"),
            dis["field_map"].alias("dis_map"),
            json_path(dis["medications_path"]).alias("meds_path"),
            dis["medication_field_map"].alias("med_map"),
        )
        .groupBy("clinic_id")
        .agg(F.max_by(F.struct("*"), "file_name").alias("r"))
        .select("r.*")
        .drop("file_name")
    )


def dims_from_folder(spark: SparkSession, folder: str) -> Dims:
    """Read a configuration folder: ``clinics/*.json`` and the four dictionary files."""
    folder = folder.rstrip("/")
    dictionary = _whole(spark, folder, _DICTIONARY, "test_dictionary.json")
    tests = dictionary.select(F.posexplode("c.tests").alias("ord", "t")).select("ord", "t.*")
    threshold = dictionary.select(F.coalesce("c._meta.fuzzy_threshold", F.lit(90.0))).first()[0]
    ranges = (
        _whole(spark, folder, _RANGES, "reference_ranges.json")
        .select(F.explode("c.ranges").alias("canonical", "r")).select("canonical", "r.*")
    )
    units = (
        _whole(spark, folder, _UNITS, "unit_conversions.json")
        .select(F.explode("c.unit_aliases").alias("unit_key", "u")).select("unit_key", "u.*")
    )
    medicines = (
        _whole(spark, folder, _MEDICINES, "medicine_mapping.json")
        .select(F.posexplode("c.medicines").alias("ord", "m")).select("ord", "m.*")
    )
    return make_dims(
        tests=tests, ranges=ranges, units=units, medicines=medicines,
        clinics=clinics_from_files(_whole(spark, f"{folder}/clinics", _CLINIC)),
        threshold=threshold / 100.0,
    )


def clinics_from_json(rows: DataFrame) -> DataFrame:
    """Layout rows from ``(file_name, text)`` when the configuration lives in a table."""
    return clinics_from_files(
        rows.select("file_name", F.from_json("text", _CLINIC, {"mode": "FAILFAST"}).alias("c"))
    )
