"""Scalar transforms as Column expressions; nothing here leaves the JVM."""

from labweave.functions.hashing import document_key, payload_hash, row_id
from labweave.functions.json_paths import (
    flatten_value, json_path, pairs_to_map, path_text, path_value, shape_ok,
)
from labweave.functions.numbers import (
    convert_value, number_text, parse_range, range_text, result_text, split_composite,
    with_number,
)
from labweave.functions.people import parse_age, parse_gender
from labweave.functions.dates import date_shape, parse_date, spark_date_pattern
from labweave.functions.status import (
    classify, display_class, range_source, severity_rank,
)
from labweave.functions.text import clean, normalise_medicine, normalise_name

__all__ = [
    "classify", "clean", "convert_value", "date_shape", "display_class", "document_key",
    "flatten_value", "json_path", "normalise_medicine", "normalise_name", "number_text",
    "pairs_to_map", "parse_age", "parse_date", "parse_gender", "parse_range", "path_text", "path_value", "payload_hash", "range_source",
    "range_text", "result_text", "row_id", "severity_rank", "shape_ok",
    "spark_date_pattern", "split_composite", "with_number",
]
