"""Content-derived keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from labweave.functions.json_paths import path_text, path_value
from labweave.functions.text import _col

# A page_no member with a scalar value, in Spark's canonical (key-sorted) JSON text. A
# quote inside a JSON string is always escaped there, so text values never match.
_SCALAR = r'(?:"(?:[^"\\]|\\.)*+"|[^,}\]"{\[]++)'
_PAGE_AFTER = rf',"page_no":{_SCALAR}'
_PAGE_FIRST = rf'\{{"page_no":{_SCALAR},?'


def payload_hash(body: Column | str, blocks_path: Column | str, *, known: Sequence[str] = ()) -> Column:
    """SHA-256 of the clinical payload: the blocks when the layout has them, else the whole
    body, with page numbers left out at every depth."""
    b = _col(body)
    blocks = F.nullif(F.to_json(path_value(b, blocks_path, known=known)), F.lit("null"))
    text = F.coalesce(blocks, F.to_json(b))
    text = F.regexp_replace(text, _PAGE_AFTER, "")
    return F.sha2(F.regexp_replace(text, _PAGE_FIRST, "{"), 256)


def document_key(body: Column | str, key_paths: Column | str, fallback: Column, *,
                 known: Sequence[str] = ()) -> Column:
    """SHA-256 of the declared identity fields that are present, else ``fallback``.

    A JSON null counts as absent: hashing the word for it would make all documents
    without ids copies of each other.
    """
    b = _col(body)
    parts = F.transform(_col(key_paths), lambda p: path_text(b, p, known=known))
    joined = F.array_join(F.filter(parts, lambda p: p != ""), "|")
    return F.when(joined != "", F.sha2(joined, 256)).otherwise(fallback)


def row_id(parts: Sequence[Column | str]) -> Column:
    """SHA-256 of the parts joined by ``|``, nulls as empty text."""
    texts = [F.coalesce(_col(p).cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("|", *texts), 256)


def id_bytes(c: Column | str) -> Column:
    """The 32 bytes that a :func:`row_id` spells in 64 characters, for moving ids."""
    return F.unhex(_col(c))
