"""Result classification and its display attributes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from labweave.functions.numbers import number_text
from labweave.functions.text import _col, clean

# Statuses, range labels, display classes.
WITHIN = "Within Range"
ABOVE = "Above Range"
BELOW = "Below Range"
OUTLIER = "Outlier"
INVALID = "Invalid"
UNCLASSIFIED = "Unclassified"
NOT_APPLICABLE = "Not Applicable"
FLAGGED = [OUTLIER, INVALID, ABOVE, BELOW]
QUEUED = FLAGGED + [UNCLASSIFIED]
DISPLAY_CLASSES = {
    OUTLIER: "pill-outlier", INVALID: "pill-invalid", ABOVE: "pill-above",
    BELOW: "pill-below", WITHIN: "pill-within", UNCLASSIFIED: "pill-unclassified",
    NOT_APPLICABLE: "pill-na",
}


def unit_mismatch(unit: Column | str, expected: Column | str) -> Column:
    """Whether a row's known unit is of another kind than the one its test is defined in."""
    u, want = _col(unit), _col(expected)
    return F.coalesce((want != "") & (u != "") & (u != want), F.lit(False))


def classify(
    *,
    name: Column | str,
    value_type: Column | str,
    number: Column | str,
    value: Column | str | None = None,
    unit: Column | str | None = None,
    expected_unit: Column | str | None = None,
    low: Column | str,
    high: Column | str,
    outlier_low: Column | str,
    outlier_high: Column | str,
) -> Column:
    """``struct(status, reason, exclude)``.

    ``number`` is a :func:`with_number` struct. ``value`` (default: the parsed number) is
    compared with the bounds; null outlier bounds mean that no range is configured. The
    first rule that applies decides: text, unit of another kind, range-shaped, missing,
    not a number, no range, outlier (strict), below, above, within (inclusive).
    """
    n = _col(number)
    v = n["value"] if value is None else _col(value)
    nm = _col(name)
    unit_c = F.lit(None).cast("string") if unit is None else _col(unit)
    want = F.lit(None).cast("string") if expected_unit is None else _col(expected_unit)
    lo, hi, olo, ohi = (_col(c) for c in (low, high, outlier_low, outlier_high))
    missing = F.coalesce(clean(n["raw"]) == "", F.lit(True))
    mismatch = unit_mismatch(unit_c, want)
    no_range = nm.isNull() | olo.isNull() | ohi.isNull()

    # (applies, status, reason, excluded) in order of precedence
    rules: list[tuple[Column, str, Column | None, bool]] = [
        (_col(value_type) == "text", NOT_APPLICABLE, None, False),
        (mismatch, INVALID, F.concat(
            F.lit("unit mismatch: '"), nm, F.lit("' expects '"), want,
            F.lit("' but this row reported '"), unit_c, F.lit("'")), True),
        (n["contradictory"], INVALID, F.lit(
            "result field holds a range instead of a single measurement"), False),
        (~n["is_numeric"] & missing, UNCLASSIFIED, F.lit("missing result"), False),
        (~n["is_numeric"], INVALID, F.concat(
            F.lit("non-numeric result '"), n["raw"], F.lit("' where a number was expected")), False),
        (no_range, UNCLASSIFIED, F.lit("no reference range configured for this test yet"), False),
        ((v < olo) | (v > ohi), OUTLIER, F.concat(
            F.lit("value "), number_text(v), F.lit(" is implausible (outside ["),
            number_text(olo), F.lit(", "), number_text(ohi), F.lit("])")), False),
        (v < lo, BELOW, None, False),
        (v > hi, ABOVE, None, False),
    ]
    nothing = F.lit(None).cast("string")
    out = F.struct(F.lit(WITHIN).alias("status"), nothing.alias("reason"),
                   F.lit(False).alias("exclude"))
    for applies, status, reason, exclude in reversed(rules):
        branch = F.struct(
            F.lit(status).alias("status"),
            (nothing if reason is None else reason).alias("reason"),
            F.lit(exclude).alias("exclude"),
        )
        out = F.when(applies, branch).otherwise(out)
    return out


def range_source(reported_low: Column | str, config_low: Column | str) -> Column:
    """Where the stored range came from."""
    return F.when(_col(reported_low).isNotNull(), F.lit("source_reported")).when(
        _col(config_low).isNotNull(), F.lit("reference_config")
    )


def severity_rank(status: Column | str) -> Column:
    s = _col(status)
    return F.when(s == OUTLIER, 0).when(s == INVALID, 1).otherwise(2)


def display_class(status: Column | str) -> Column:
    known = F.create_map(*[F.lit(x) for kv in DISPLAY_CLASSES.items() for x in kv])
    return F.coalesce(
        F.try_element_at(known, _col(status)), F.lit(DISPLAY_CLASSES[UNCLASSIFIED])
    )
