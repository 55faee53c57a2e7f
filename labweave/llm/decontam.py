"""Benchmark decontamination with an FM-index per shard of the training texts.

Words are runs of letters, digits and non-ASCII characters, A-Z lowered. The phrases are the
windows of ``window`` consecutive words of a benchmark item; a shorter item is one window.

A shard is a batch of documents. Its symbols are the words that some phrase has; any other word
ends a stretch, because no phrase can cross it, and stretches shorter than the shortest phrase
are left out. The index over the shard's stretches is a suffix order (prefix doubling), the
Burrows-Wheeler symbols in a wavelet matrix, and every ``SAMPLE``-th suffix position. All phrases
are searched backwards at once; each row of a found range is walked to a sampled position;
positions become (document, word) spans, which are merged. Nothing is moved between tasks: the
work is one pass over the documents, each in its own task, and a lost task is repeated alone.

The phrases are broadcast in blocks of about ``max_chars`` characters, measured beforehand; each
block is fetched alone and is one pass over the same texts, whose finds are landed and merged per
document, so the number of blocks does not change the result.

Null or empty texts have no words, no hits and are not contaminated; items without words or
without an id match nothing; repeated items count once; repeated documents each get their row;
extra columns are ignored unless named in ``keep``.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from labweave.llm.common import in_arrow, row_key, unused
from labweave.session import checkpoint

#: Characters of documents per shard, and of benchmark items per pass.
SHARD_CHARS = 12_000_000
MAX_CHARS = 16_000_000
SAMPLE = 8
#: Symbols: the shard's end (once), the end of a stretch, then the phrases' words.
END, STOP, FIRST = 0, 1, 2

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans(ascii_uppercase, ascii_lowercase)
_SEPARATORS = bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(
    range(0x7B, 0x80))
#: Byte table: A-Z to a-z, every other ASCII character that is no letter or digit to a blank.
_FOLD = bytes.maketrans(
    _SEPARATORS + bytes(range(0x41, 0x5B)), b" " * len(_SEPARATORS) + bytes(range(0x61, 0x7B)))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


class Phrases:
    """Distinct windows over the benchmark's own word numbers, and the items that have them."""

    def __init__(self, items: Iterable[tuple[str, str]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for name, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + FIRST) for w in words_of(text)]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                owners[tuple(ids[i:i + window])].add(name)
        self.owners = list(owners.values())
        by_size: dict[int, list[int]] = defaultdict(list)
        windows = list(owners)
        for k, w in enumerate(windows):
            by_size[len(w)].append(k)
        self.shortest = min(by_size, default=0)
        self.groups = [(np.array(ks), np.array([windows[k] for k in ks], np.int64))
                       for _, ks in sorted(by_size.items())]


class WaveletMatrix:
    """Ranks of symbols below 2**levels: per level a bit string, with a count per byte of it."""

    _ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)

    def __init__(self, symbols: np.ndarray, levels: int):
        self.bits, self.ahead, self.zeros = [], [], []
        self.levels = levels
        for level in reversed(range(levels)):
            bit = ((symbols >> level) & 1).astype(np.uint8)
            packed = np.append(np.packbits(bit, bitorder="little"), np.uint8(0))
            self.bits.append(packed)
            self.ahead.append(np.concatenate(
                [[0], np.cumsum(self._ONES[packed], dtype=np.int64)]).astype(np.uint32))
            self.zeros.append(len(symbols) - int(bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def _ones(self, k: int, at: np.ndarray) -> np.ndarray:
        byte, rest = at >> 3, (at & 7).astype(np.uint8)
        mask = ((np.uint16(1) << rest) - 1).astype(np.uint8)
        return self.ahead[k][byte].astype(np.int64) + self._ONES[self.bits[k][byte] & mask]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs ahead of its position."""
        start = np.zeros_like(at)
        for k in range(self.levels):
            bit = (symbol >> (self.levels - 1 - k)) & 1
            a, b = self._ones(k, start), self._ones(k, at)
            start = np.where(bit, self.zeros[k] + a, start - a)
            at = np.where(bit, self.zeros[k] + b, at - b)
        return at - start

    def at(self, at: np.ndarray) -> np.ndarray:
        """The symbol at each position."""
        out = np.zeros_like(at)
        for k in range(self.levels):
            byte, rest = at >> 3, (at & 7).astype(np.uint8)
            bit = ((self.bits[k][byte] >> rest) & 1).astype(np.int64)
            ones = self._ones(k, at)
            at = np.where(bit, self.zeros[k] + ones, at - ones)
            out = (out << 1) | bit
        return out


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in order, by prefix doubling. A suffix that ends sorts
    ahead of its continuations."""
    n = len(symbols)
    _, rank = np.unique(symbols, return_inverse=True)
    rank, step = rank.astype(np.int64) + 1, 1
    while True:
        behind = np.zeros(n, np.int64)
        if step < n:
            behind[:-step] = rank[step:]
        key = rank * (n + 1) + behind
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.concatenate([[1], 1 + np.cumsum(key[1:] != key[:-1])])
        rank = np.empty(n, np.int64)
        rank[order] = new
        if n == 0 or new[-1] == n:
            return order
        step *= 2


class ShardIndex:
    """FM-index of one shard's symbols, which END closes."""

    def __init__(self, symbols: np.ndarray, size: int):
        n = len(symbols)
        order = suffix_order(symbols)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=size + 1))])
        last = symbols[order - 1]  # ahead of the first symbol stands END
        self.wavelet = WaveletMatrix(last, max(1, int(size).bit_length()))
        self.n = n
        marked = (order % SAMPLE == 0) | (order == 0)
        self.marked = marked
        self.number = np.cumsum(marked) - 1
        self.positions = order[marked]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of phrases of one length, all searched backwards together."""
        lo = np.zeros(len(phrases), np.int64)
        hi = np.full(len(phrases), self.n, np.int64)
        for j in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[:, j]
            lo, hi = self.before[c] + self.wavelet.rank(c, lo), self.before[c] + self.wavelet.rank(c, hi)
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: step back until a row's position was sampled."""
        out = np.empty(len(rows), np.int64)
        open_, steps = np.arange(len(rows)), 0
        while len(open_):
            here = self.marked[rows]
            out[open_[here]] = self.positions[self.number[rows[here]]] + steps
            rows, open_ = rows[~here], open_[~here]
            c = self.wavelet.at(rows)
            rows = self.before[c] + self.wavelet.rank(c, rows)
            steps += 1
        return out


def find_in_shard(
    texts: Iterable[str | None], phrases: Phrases
) -> tuple[list[int], dict[int, tuple[list, set]]]:
    """Word counts of all texts; of those with hits, the merged word spans [first, end) and the
    names of the items found."""
    get = phrases.vocabulary.get
    sizes, parts, where, at = [], [], [], 0
    for d, text in enumerate(texts):
        words = words_of(text)
        sizes.append(len(words))
        ids = np.fromiter((get(w, 0) for w in words), np.int32, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate([[0], ids != 0, [0]]).astype(np.int8)))
        for a, b in edges.reshape(-1, 2):
            if phrases.shortest and b - a >= phrases.shortest:
                parts += [ids[a:b], [STOP]]
                where.append((at, d, a))
                at += b - a + 1
    hits: dict[int, tuple[list, set]] = {}
    if not parts:
        return sizes, hits
    symbols = np.concatenate([*parts, [END]]).astype(np.int64)
    index = ShardIndex(symbols, len(phrases.vocabulary) + FIRST)
    starts, docs, firsts = np.array(where, np.int64).T
    for ks, group in phrases.groups:
        lo, hi = index.search(group)
        found = np.flatnonzero(hi > lo)
        if not len(found):
            continue
        many = (hi - lo)[found]
        rows = np.repeat(lo[found] - np.cumsum(many) + many, many) + np.arange(many.sum())
        places = index.locate(rows)
        stretch = np.searchsorted(starts, places, "right") - 1
        begin = firsts[stretch] + places - starts[stretch]
        for k, d, a in zip(np.repeat(ks[found], many).tolist(), docs[stretch].tolist(),
                           begin.tolist()):
            spans, names = hits.setdefault(d, ([], set()))
            spans.append((a, a + group.shape[1]))
            names |= phrases.owners[k]
    return sizes, {d: (merge_spans(spans), names) for d, (spans, names) in hits.items()}


def merge_spans(spans: Iterable[Sequence[int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(map(tuple, spans)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_FOUND = pa.schema([
    ("n_words", pa.int64()), ("spans", pa.list_(pa.list_(pa.int32()))),
    ("items", pa.list_(pa.string()))])
_FOUND_SQL = "n_words long, spans array<array<int>>, items array<string>"


def item_blocks(items: DataFrame, max_chars: int) -> list[DataFrame]:
    """The items' (id as text, text) as tables of about ``max_chars`` characters; one at least."""
    named = items.select(F.col("item_id").cast("string").alias("name"), "text").filter(
        "name is not null and text is not null").distinct()
    chars = named.agg(F.coalesce(F.sum(F.length("text") + 20), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // max_chars))
    return [named.filter(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == k)
            for k in range(blocks)]


def _phrases(block: DataFrame, window: int) -> Broadcast:
    items = (tuple(r) for r in block.collect())
    return block.sparkSession.sparkContext.broadcast(Phrases(items, window))


def shards_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    held, chars = [], 0
    for batch in batches:
        held.append(batch)
        chars += batch.column("text").nbytes
        if chars >= SHARD_CHARS:
            yield held
            held, chars = [], 0
    if held:
        yield held


def _pass(docs: DataFrame, phrases: Broadcast, out: Sequence[str]) -> DataFrame:
    """``out`` columns of ``docs`` with n_words, spans and items, shard by shard in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = ([], ())
        for held in shards_of(batches):
            texts = (t for b in held for t in b.column("text").to_pylist())
            sizes, hits = find_in_shard(texts, phrases.value)
            d = 0
            for b in held:
                mine = [hits.get(i, none) for i in range(d, d + b.num_rows)]
                found = [pa.array(sizes[d:d + b.num_rows], pa.int64()),
                         pa.array([s for s, _ in mine], _FOUND.field("spans").type),
                         pa.array([sorted(n) for _, n in mine], _FOUND.field("items").type)]
                d += b.num_rows
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c) for c in out], *found], names=[*out, *_FOUND.names])

    kinds = dict(docs.dtypes)
    return in_arrow(docs, run, ", ".join(f"`{c}` {kinds[c]}" for c in out) + f", {_FOUND_SQL}")


@F.pandas_udf(ArrayType(ArrayType(IntegerType())))
def _merged(spans: pd.Series) -> pd.Series:
    return spans.map(lambda s: [list(x) for x in merge_spans(s)])


def _landed(src: DataFrame, blocks: Iterable[DataFrame], window: int) -> DataFrame:
    """``row, spans, items`` of each row and block with finds; one block is held at a time."""
    parts = []
    for block in blocks:
        phrases = _phrases(block, window)
        found = _pass(src, phrases, ["row"]).filter(F.size("items") > 0).select("row", "spans", "items")
        parts.append(checkpoint(found, "spans"))
        phrases.destroy()
    return reduce(DataFrame.unionByName, parts)


def find_items(
    docs: DataFrame, items: DataFrame, *, window: int = 10, max_chars: int = MAX_CHARS,
    keep: Sequence[str] = ("doc_id",),
) -> DataFrame:
    """Columns named in ``keep`` and what was found in ``text``: ``n_words``, ``spans`` (disjoint
    word intervals covered by windows) and ``items`` (their ids as text, sorted)."""
    src = docs.select(*[F.col(c).alias(f"keep_{c}") for c in keep], "text")
    out = [f"keep_{c}" for c in keep]
    *others, last = item_blocks(items, max_chars)
    if not others:
        found = _pass(src, _phrases(last, window), out)
    else:  # several passes; what each found is gathered by row, a small array a pass
        src = src.withColumn("row", row_key(*[F.col(c) for c in src.columns]))
        more = _landed(src, others, window).groupBy("row").agg(
            F.flatten(F.collect_set("spans")).alias("more_spans"),
            F.flatten(F.collect_set("items")).alias("more_items"))
        found = _pass(src, _phrases(last, window), [*out, "row"])
        both = lambda a, b: F.coalesce(F.concat(a, b), F.col(a))
        found = found.join(more, "row", "left").select(
            *out, "n_words", _merged(both("spans", "more_spans")).alias("spans"),
            F.array_sort(F.array_distinct(both("items", "more_items"))).alias("items"))
    return found.withColumnsRenamed({f"keep_{c}": c for c in keep})


def digest(found: DataFrame) -> DataFrame:
    """Counts per document and the digest of its items, from :func:`find_items`."""
    hit = F.aggregate("spans", F.lit(0), lambda s, x: s + x[1] - x[0]).cast("long")
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("items") > 0).alias("contaminated"))


def without_spans(text: str, spans: Iterable[Sequence[int]]) -> str:
    """The text without the words of the spans; what stood around them stays."""
    spans = merge_spans(spans)
    if not spans:
        return text
    places = [m.span() for m in _WORD.finditer(text.translate(_LOWER))]
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:places[a][0]])
        at = places[b - 1][1]
    return "".join([*out, text[at:]])


def clean_text(text: str, phrases: Phrases) -> str:
    """The text without all phrases, also those that a removal brings together."""
    while hits := find_in_shard([text], phrases)[1]:
        text = without_spans(text, hits[0][0])
    return text


@F.pandas_udf(StringType())
def _cut(text: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([without_spans(t, s) for t, s in zip(text, spans)], dtype=object)


def remove_items(
    docs: DataFrame, items: DataFrame, *, window: int = 10, max_chars: int = MAX_CHARS
) -> DataFrame:
    """All rows and columns of ``docs``, with every word inside an occurrence of a window taken
    out of ``text``, also those that a removal brings together."""
    blocks = item_blocks(items, max_chars)
    if len(blocks) == 1:
        return _cut_pass(docs, _phrases(blocks[0], window))
    row, new = unused(docs, "row"), unused(docs, "cut")
    keyed = docs.withColumn(row, row_key(*[F.col(c) for c in docs.columns]))
    texts, rounds = keyed.select(F.col(row).alias("row"), "text"), []
    while True:  # the spans of all blocks are cut at once; only changed texts are searched again
        found = _landed(texts, blocks, window).groupBy("row").agg(
            F.flatten(F.collect_set("spans")).alias("spans"))
        texts = checkpoint(texts.dropDuplicates(["row"]).join(found, "row").select(
            "row", _cut("text", "spans").alias("text")), "cut")
        if texts.isEmpty():
            break
        rounds.append(texts.withColumn("round", F.lit(len(rounds))))
    if not rounds:
        return docs
    cut = reduce(DataFrame.unionByName, rounds).groupBy(F.col("row").alias(row)).agg(
        F.max_by("text", "round").alias(new))
    return keyed.join(cut, row, "left").withColumn("text", F.coalesce(new, "text")).select(
        *docs.columns)


def _cut_pass(docs: DataFrame, phrases: Broadcast) -> DataFrame:
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in shards_of(batches):
            texts = [t for b in held for t in b.column("text").to_pylist()]
            for d, (spans, _) in find_in_shard(texts, phrases.value)[1].items():
                texts[d] = clean_text(without_spans(texts[d], spans), phrases.value)
            for b in held:
                mine = pa.array(texts[:b.num_rows], pa.string())
                del texts[:b.num_rows]
                yield pa.RecordBatch.from_arrays(
                    [mine if c == "text" else b.column(c) for c in names], names=names)

    return in_arrow(docs, run, ", ".join(f"`{c}` {k}" for c, k in docs.dtypes))
