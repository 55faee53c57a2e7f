"""Numbers, ranges and composite results found in free text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from labweave.functions.text import _col, clean, none_if_blank

# Result words that are never numbers.
NON_NUMERIC_WORDS = [
    "negative", "positive", "normal", "nil", "present", "absent", "abnormal",
    "clear", "pale yellow", "trace", "pending", "n/a", "na", "nill",
]
# Shapes recognised in result and range text.
NUMBER = r"-?[0-9]+\.?[0-9]*"
RANGE = rf"^\s*({NUMBER})\s*-\s*({NUMBER})\s*$"
FLAG = r"(?i)^([HL])\b"
COMPOSITE = r"([A-Za-z][A-Za-z0-9 /().,&+\-]*?)\s*-\s*([0-9.]+)"


def with_number(df: DataFrame, result: str, out: str = "number") -> DataFrame:
    """Add ``out``: ``struct(value, flag, residual_unit, is_numeric, contradictory, raw)``.

    The first number wins; a leading stand-alone H or L is a flag; text that is only
    a range is contradictory, and known words are not numbers. Each step is a projection of
    its own, so a pattern runs once per row however often its outcome is used later.
    """
    t, body, number = F.col("_t"), F.col("_body"), F.col("_number")
    low = F.lower(t)
    word = low.isin(NON_NUMERIC_WORDS) | F.replace(low, F.lit(" "), F.lit("")).isin(
        NON_NUMERIC_WORDS
    )
    steps = [
        {"_t": clean(result)},
        {
            "_word": F.coalesce(word | (t == ""), F.lit(True)),
            "_range": F.coalesce(t.rlike(RANGE), F.lit(False)),
            "_flag": F.upper(F.regexp_extract(t, FLAG, 1)),
        },
        {
            "_body": F.when(F.col("_flag") != "", clean(F.substring(t, F.lit(2), F.length(t))))
            .otherwise(t),
            "_plain": ~F.col("_word") & ~F.col("_range"),
        },
        {"_number": F.when(F.col("_plain"), none_if_blank(F.regexp_extract(body, NUMBER, 0)))},
        {
            # The first occurrence of the number found is where it was found.
            "_around": F.when(number.isNotNull(), F.concat(
                F.substring(body, F.lit(1), F.position(number, body) - 1),
                F.substring(body, F.position(number, body) + F.length(number), F.length(body)),
            )),
            "_value": number.try_cast("double"),
        },
    ]
    for step in steps:
        df = df.withColumns(step)
    return df.withColumn(out, F.struct(
        F.col("_value").alias("value"),
        F.when(F.col("_plain"), none_if_blank("_flag")).alias("flag"),
        none_if_blank(clean("_around")).alias("residual_unit"),
        F.col("_value").isNotNull().alias("is_numeric"),
        (~F.col("_word") & F.col("_range")).alias("contradictory"),
        F.col(result).alias("raw"),
    )).drop("_t", "_word", "_range", "_flag", "_body", "_plain", "_number", "_around", "_value")


def parse_range(c: Column | str) -> Column:
    """``struct(low, high)`` from ``"a-b"``; both null when the text has another shape."""
    text = clean(c)
    low = none_if_blank(F.regexp_extract(text, RANGE, 1)).try_cast("double")
    high = none_if_blank(F.regexp_extract(text, RANGE, 2)).try_cast("double")
    both = low.isNotNull() & high.isNotNull()
    return F.struct(F.when(both, low).alias("low"), F.when(both, high).alias("high"))


def split_composite(c: Column | str) -> Column:
    """``array<struct<name, value>>`` for ``"a - 1, b - 2"`` text, null when not composite."""
    text = _col(c)
    # Null where it can't be composite, so that the patterns run on texts with a comma alone.
    text = F.when(F.contains(text, F.lit(",")), text)
    names = F.regexp_extract_all(text, F.lit(COMPOSITE), F.lit(1))
    values = F.regexp_extract_all(text, F.lit(COMPOSITE), F.lit(2))
    parts = F.zip_with(
        names,
        values,
        lambda n, v: F.struct(F.btrim(n, F.lit(" ,")).alias("name"), v.alias("value")),
    )
    return F.when(F.size(names) >= 2, parts)


def convert_value(value: Column | str, factor: Column | str) -> Column:
    """Value in the canonical unit; an unknown unit leaves it as it is."""
    return _col(value) * F.coalesce(_col(factor), F.lit(1.0))


def number_text(c: Column | str) -> Column:
    """A double as text with at least one decimal, never in scientific notation from 1e7 up."""
    v = _col(c)
    plain = F.regexp_replace(v.try_cast("decimal(38,6)").cast("string"), r"(\.[0-9]+?)0+$", "$1")
    odd = (F.abs(v) >= 1e7) | ((F.abs(v) < 1e-3) & (v != 0))
    return F.when(odd, F.coalesce(plain, v.cast("string"))).otherwise(v.cast("string"))


def range_text(low: Column | str, high: Column | str, raw: Column | str) -> Column:
    """``low-high`` when both bounds are known, else the reported text."""
    both = _col(low).isNotNull() & _col(high).isNotNull()
    return F.when(both, F.concat(number_text(low), F.lit("-"), number_text(high))).otherwise(
        _col(raw)
    )


def result_text(value: Column | str, text: Column | str) -> Column:
    """The number when there is one, else the reported text."""
    return F.coalesce(number_text(value), _col(text))
