"""Schema-on-read access to VARIANT documents through paths held in columns.

The path is data, so one plan reads every source layout and a new layout is a new
configuration row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from labweave.functions.text import _col


def _get(value: Column, path: Column, kind: str) -> Column:
    return F.call_function("try_variant_get", value, path, F.lit(kind))


def json_path(dotted: Column | str) -> Column:
    """``a.b`` as ``$['a']['b']``; a blank path stays null."""
    steps = F.transform(
        F.split(F.nullif(_col(dotted), F.lit("")), r"\."),
        lambda s: F.concat(F.lit("['"), s, F.lit("']")),
    )
    return F.concat(F.lit("$"), F.array_join(steps, ""))


def field_path(name: Column | str) -> Column:
    """One member, whatever characters its name holds."""
    return F.concat(F.lit("$['"), _col(name), F.lit("']"))


def path_value(value: Column | str, path: Column | str, kind: str = "variant", *,
               known: Sequence[str] = ()) -> Column:
    """The member at a ``$`` path as ``kind``, null when missing. A JSON null stays a
    VARIANT null under ``kind="variant"`` and is SQL null for every other kind.

    A path that is a value is parsed again for every row, at many times the cost of the lookup.
    ``known`` names paths that occur, which are parsed once; any other is still found.
    """
    v, p = _col(value), _col(path)
    out = _get(v, p, kind)
    for one in reversed(known):
        out = F.when(p == F.lit(one), _get(v, F.lit(one), kind)).otherwise(out)
    return out


def path_text(value: Column | str, path: Column | str, *, known: Sequence[str] = ()) -> Column:
    return path_value(value, path, "string", known=known)


def members(value: Column | str) -> Column:
    """Top-level members of an object as a map, null for anything else."""
    return _get(_col(value), F.lit("$"), "map<string,variant>")


def is_object(value: Column | str) -> Column:
    """Whether a VARIANT is an object, without copying its members."""
    return _get(_col(value), F.lit("$"), "struct<_: variant>").isNotNull()


def shape_ok(value: Column | str, required: Column | str) -> Column:
    """Whether every required top-level key is present; a null value still counts."""
    keys = F.map_keys(members(value))
    return F.coalesce(F.forall(_col(required), lambda k: F.array_contains(keys, k)), F.lit(False))


def pairs_to_map(value: Column | str, path: Column | str, *, known: Sequence[str] = ()) -> Column:
    """``[{key, value}, ...]`` at ``path`` as a map; the last of equal keys wins and items
    without a key are skipped."""
    items = F.coalesce(
        path_value(value, path, "array<map<string,variant>>", known=known),
        F.array().cast("array<map<string,variant>>"),
    )
    keyed = F.filter(items, lambda m: F.map_contains_key(m, "key"))
    entries = F.transform(
        keyed,
        lambda m: F.struct(
            F.coalesce(m["key"].cast("string"), F.lit("None")).alias("key"),
            F.try_element_at(m, F.lit("value")).cast("string").alias("value"),
        ),
    )
    return F.map_from_entries(entries)


def flatten_value(value: Column | str) -> Column:
    """A VARIANT as one text: list items joined by ``"; "`` (empty list is null), objects as
    JSON, scalars as they are."""
    v = _col(value)
    items = F.transform(
        _get(v, F.lit("$"), "array<variant>"),
        lambda x: F.coalesce(x.try_cast("string"), F.lit("None")),
    )
    return F.when(
        items.isNotNull(), F.nullif(F.array_join(items, "; "), F.lit(""))
    ).otherwise(_get(v, F.lit("$"), "string"))
