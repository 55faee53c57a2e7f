"""Dates written in many formats."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from labweave.functions.text import _col, clean

# Placeholders, and the formats tried after the declared one, in order.
NO_DATE = ["DD/MM/YYYY", "N/A", "NA"]
FALLBACK_FORMATS = [
    "d/M/yyyy", "M/d/yyyy", "yyyy-M-d", "d-M-yyyy", "d.M.yyyy",
    "d-MMM-yyyy", "d/MMM/yyyy", "d-MMMM-yyyy", "d/MMMM/yyyy",
]
_SHAPES = {"d": "[0-9]{1,2}", "M": "[0-9]{1,2}", "yyyy": "[0-9]{4}", "MMM": "[A-Za-z]{3}",
           "MMMM": "[A-Za-z]{3,9}"}
# Strptime directive -> Spark pattern letters; run-together ones need all digits.
DIRECTIVES = {
    "%Y%m%d": "yyyyMMdd", "%d%m%Y": "ddMMyyyy", "%m%d%Y": "MMddyyyy",
    "%d": "d", "%m": "M", "%Y": "yyyy", "%y": "yy", "%b": "MMM", "%B": "MMMM",
    "%H": "H", "%M": "m", "%S": "s",
}


def spark_date_pattern(c: Column | str) -> Column:
    """A ``%d/%m/%Y`` style format as the Spark pattern that accepts the same text."""
    out = _col(c)
    for directive, letters in DIRECTIVES.items():
        out = F.replace(out, F.lit(directive), F.lit(letters))
    return out


def _shape(pattern: str) -> str:
    return "^" + re.sub(r"[A-Za-z]+", lambda m: _SHAPES[m[0]], pattern.replace(".", "[.]")) + "$"


def date_shape(c: Column | str) -> Column:
    """A ``%d/%m/%Y`` style format as a pattern every text it accepts must match."""
    out = F.replace(_col(c), F.lit("."), F.lit("[.]"))
    for directive, letters in DIRECTIVES.items():
        if len(directive) == 2:
            out = F.replace(out, F.lit(directive), F.lit(_SHAPES.get(letters, "[0-9]{1,2}")))
    return F.concat(F.lit("^"), out, F.lit("$"))


def parse_date(
    c: Column | str, declared: Column | str | None = None, shape: Column | None = None
) -> Column:
    """Date from text: the declared Spark pattern first, then the fallbacks; null if none fits.

    A failed parse costs an exception, so a format is tried only on text of its shape;
    ``shape`` is the declared format's (:func:`date_shape`).
    """
    text = clean(c)
    tries = [F.when(text.rlike(_shape(f)), F.try_to_date(text, f)) for f in FALLBACK_FORMATS]
    if declared is not None:
        pattern = F.lit(declared) if isinstance(declared, str) else declared
        first = F.call_function("try_to_date", text, pattern)
        tries.insert(0, first if shape is None else F.when(F.rlike(text, shape), first))
    return F.when((text != "") & ~F.upper(text).isin(NO_DATE), F.coalesce(*tries))
