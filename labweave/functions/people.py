"""Age and gender."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from labweave.functions.text import _col, clean, none_if_blank

# Gender spellings, unreadable ages, composite age shape.
GENDERS = {
    "m": "Male", "male": "Male", "man": "Male",
    "f": "Female", "female": "Female", "woman": "Female",
    "o": "Other", "other": "Other", "trans": "Other",
}
NO_AGE = ["[AGE REDACTED]", "N/A", "NA"]
AGE_PARTS = r"(?i)^(?:([0-9]+)\s*Y)?\s*(?:([0-9]+)\s*M)?\s*(?:([0-9]+)\s*D)?"


def parse_age(c: Column | str) -> Column:
    """``struct(age_text, age_years, age_months, age_days)`` from ``41``, ``29Y`` or ``33Y11M265D``."""
    text = clean(c)
    readable = (text != "") & ~F.upper(text).isin(NO_AGE)
    years_only = text.rlike(r"^[0-9]+(\.[0-9]+)?$")
    y, m, d = (F.regexp_extract(text, AGE_PARTS, i) for i in (1, 2, 3))
    composite = readable & ~years_only & (F.concat(y, m, d) != "")

    def part(p: Column) -> Column:
        return F.when(composite, F.coalesce(none_if_blank(p), F.lit("0")).try_cast("double"))

    return F.struct(
        none_if_blank(text).alias("age_text"),
        F.when(readable & years_only, text.try_cast("double")).otherwise(part(y)).alias("age_years"),
        part(m).alias("age_months"),
        part(d).alias("age_days"),
    )


def parse_gender(c: Column | str) -> Column:
    """Male, Female or Other; blank and redacted are null; anything else stays as given."""
    raw = _col(c)
    low = F.lower(clean(raw))
    known = F.create_map(*[F.lit(x) for kv in GENDERS.items() for x in kv])
    hidden = (low == "") | F.contains(low, F.lit("redacted"))
    return F.when(~hidden, F.coalesce(F.try_element_at(known, low), raw))
