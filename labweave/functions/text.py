"""Text cleaning shared by the matchers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Every character a Unicode-aware strip removes; F.trim alone only takes spaces.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean(c: Column | str) -> Column:
    """Strip white space at both ends."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def none_if_blank(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def normalise_name(c: Column | str) -> Column:
    """Name key for dictionary lookup: lower case, no bracketed notes, a-z 0-9 + / only."""
    no_notes = F.regexp_replace(F.lower(_col(c)), r"\([^)]*\)", "")
    return F.trim(F.regexp_replace(no_notes, r"[^a-z0-9+/]+", " "))


def normalise_medicine(c: Column | str) -> Column:
    """Medicine key: no strength, no dosage form, letters only."""
    s = F.lower(_col(c))
    s = F.regexp_replace(s, r"\b\d+\s*(mg|ml|mcg|g)\b", "")
    s = F.regexp_replace(s, r"\b(tab|tablet|inj|injection|cap|capsule|syrup)\b", "")
    return F.trim(F.regexp_replace(s, r"[^a-z]+", " "))
