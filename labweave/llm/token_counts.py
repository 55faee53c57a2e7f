"""Token counts by section: offset-mapped attribution.

A whole document is encoded once. Its tokens' byte lengths add up to byte spans, which become
character spans (a token has the characters whose first byte it has or lies within). Sections are
character spans of the text; tokens and sections are joined by interval overlap, and a token
that crosses a boundary is allocated by one of three rules:

``majority``  to the section with most of its bytes; ties go to the earlier section
``start``     to the section of its first byte
``split``     to each section in proportion to its bytes (counts are then fractions)

A token outside all sections counts for none. Without given sections every line, with its line
break, is one; so the lines of a text always add up to the tokens of the text.

Null or empty texts have no sections of their own (given ones get zero tokens); null sections
count as none given; overlapping given sections each get their share under ``start`` and
``split``, and the earlier one wins under ``majority``; repeated rows each get their rows; extra
columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from labweave.llm.common import in_arrow

RULES = ("majority", "start", "split")
#: How the public byte-level vocabularies cut text ahead of merging: a fixed value of theirs.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def read_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class Encoder:
    """Token ids and byte spans of whole texts."""

    def __init__(self, ranks: dict[bytes, int]):
        import tiktoken

        self.encoding = tiktoken.Encoding(
            "text", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for piece, rank in ranks.items():
            self.lengths[rank] = len(piece)

    def edges(self, text: str) -> np.ndarray:
        """Byte offsets between tokens, from 0 to the text's length."""
        ids = self.encoding.encode_ordinary(text)
        return np.concatenate([[0], np.cumsum(self.lengths[ids])]).astype(np.int64)


def line_spans(text: str) -> list[tuple[int, int]]:
    """Character spans of the lines, each with its break."""
    out, at = [], 0
    for line in text.split("\n"):
        end = min(len(text), at + len(line) + 1)
        if end > at:
            out.append((at, end))
        at = end
    return out


def byte_offsets(text: str, raw: bytes, at: np.ndarray) -> np.ndarray:
    """Byte offsets of character offsets."""
    if len(raw) == len(text):
        return at
    starts = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    return np.append(starts, len(raw))[np.clip(at, 0, len(text))]


def allocate(edges: np.ndarray, spans: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per span and how many of them cross a border of it; all offsets in bytes.

    The join runs over spans: each meets only the tokens from its first to its last byte.
    """
    counts = np.zeros(len(spans), np.float64)
    crossing = np.zeros(len(spans), np.int64)
    n = len(edges) - 1
    if not n or not len(spans):
        return counts, crossing
    lo, hi = np.minimum(spans, edges[-1]).T
    first = np.searchsorted(edges, lo, "right") - 1   # token with the span's first byte
    last = np.searchsorted(edges, hi, "left") - 1     # token with its last byte
    some = (hi > lo) & (lo < edges[-1])
    below, above = edges[first[some]] < lo[some], edges[last[some] + 1] > hi[some]
    crossing[some] = np.where(first[some] == last[some], below | above,
                              below.astype(int) + above.astype(int))
    if rule == "start":
        counts[some] = (np.searchsorted(edges[:-1], hi) - np.searchsorted(edges[:-1], lo))[some]
        return counts, crossing
    whole_lo = np.searchsorted(edges, lo, "left")     # tokens fully inside: from here
    whole_hi = np.searchsorted(edges, hi, "right") - 1
    inside = np.maximum(0, whole_hi - whole_lo)
    if rule == "split":
        counts[some] = inside[some]
        for k in np.flatnonzero(some & (crossing > 0)):
            for t in {int(first[k]), int(last[k])}:
                a, b = edges[t], edges[t + 1]
                if a < lo[k] or b > hi[k]:
                    counts[k] += (min(b, hi[k]) - max(a, lo[k])) / (b - a)
        return counts, crossing
    # Majority: every token goes to one span. Whole ones first, then the border tokens one by one.
    taken = np.zeros(n, bool)
    best: dict[int, tuple[int, int]] = {}
    for k in np.argsort(lo, kind="stable"):
        if not some[k]:
            continue
        a, b = int(whole_lo[k]), int(whole_hi[k])
        if b > a:
            counts[k] += int((~taken[a:b]).sum())
            taken[a:b] = True
        for t in {int(first[k]), int(last[k])}:
            if edges[t] < lo[k] or edges[t + 1] > hi[k]:
                share = int(min(edges[t + 1], hi[k]) - max(edges[t], lo[k]))
                if share > best.get(t, (0, 0))[0]:
                    best[t] = (share, int(k))
    for t, (_, k) in best.items():
        if not taken[t]:
            counts[k] += 1
    return counts, crossing


def token_counts(
    docs: DataFrame, vocabulary: str, *, id_cols: Sequence[str] = ("doc_id",), text: str = "text",
    sections: str | None = None, rule: str = "majority",
) -> DataFrame:
    """``id_cols``, ``section`` (from 0), ``start_char``, ``end_char``, ``n_tokens``, ``n_crossing`` and
    the text's ``doc_tokens``, one row per section.

    ``vocabulary`` is a file of byte-level ranks, ``sections`` a column of
    ``array<struct<start: int, end: int>>`` in characters.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    spark = docs.sparkSession
    if "://" in vocabulary:
        data = bytes(spark.read.format("binaryFile").load(vocabulary).select("content").first()[0])
    else:
        with open(vocabulary, "rb") as f:
            data = f.read()
    ranks = spark.sparkContext.broadcast(data)  # one vocabulary file, under a megabyte
    given = (F.transform(sections, lambda s: F.array(s["start"].cast("int"), s["end"].cast("int")))
             if sections else F.lit(None).cast("array<array<int>>"))
    src = docs.select(*[F.col(c).alias(f"k_{c}") for c in id_cols],
                      F.coalesce(F.col(text), F.lit("")).alias("text"), given.alias("given"))
    keys = [f"k_{c}" for c in id_cols]
    count_type = "double" if rule == "split" else "long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(read_ranks(ranks.value))
        for b in batches:
            row, number, starts, ends, counts, crossing, totals = [], [], [], [], [], [], []
            for i, (t, spans) in enumerate(zip(
                    b.column("text").to_pylist(), b.column("given").to_pylist())):
                spans = np.array([s for s in spans if None not in s] if spans is not None
                                 else line_spans(t), np.int64).reshape(-1, 2)
                edges = encoder.edges(t)
                raw = t.encode()
                at = byte_offsets(t, raw, np.clip(spans, 0, len(t)))
                n, x = allocate(edges, at, rule)
                row.append(np.full(len(spans), i))
                number.append(np.arange(len(spans)))
                starts.append(spans[:, 0])
                ends.append(spans[:, 1])
                counts.append(n)
                crossing.append(x)
                totals.append(np.full(len(spans), len(edges) - 1))
            if not row:
                continue
            join = np.concatenate
            take = pa.array(join(row).astype(np.int64))
            n = join(counts)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(k).take(take) for k in keys],
                 pa.array(join(number).astype(np.int32)), pa.array(join(starts).astype(np.int32)),
                 pa.array(join(ends).astype(np.int32)),
                 pa.array(n if rule == "split" else n.astype(np.int64)),
                 pa.array(join(crossing).astype(np.int64)), pa.array(join(totals).astype(np.int64))],
                names=[*keys, "section", "start_char", "end_char", "n_tokens", "n_crossing",
                       "doc_tokens"])

    kinds = dict(src.dtypes)
    out = in_arrow(src, run, ", ".join(f"`{k}` {kinds[k]}" for k in keys) +
                   f", section int, start_char int, end_char int, n_tokens {count_type}, "
                   "n_crossing long, doc_tokens long")
    return out.withColumnsRenamed({f"k_{c}": c for c in id_cols})
