"""Cross-tokenizer alignment by divide and conquer at shared cuts.

A text (with one space in front) is encoded by a byte-level vocabulary A and a piece vocabulary
B; both spell out the same bytes. A byte offset where tokens of both end is a shared cut. An interval
of tokens is halved at a shared cut near its middle: the end of A's middle token is looked up among
B's ends by bisection, and if it is none of them, the ends beside it, alternately to the right and left.
Both halves go on alike; an interval without a shared cut inside is a leaf and becomes a group. The
intervals of all texts of a batch that have the same depth are halved together, as arrays.

Within a group every A token is linked to each B token whose bytes overlap its own. Links are
counted per (A id, B id) over the whole corpus without holding its pairs in one place: texts are
packed into blocks; a block hands over its distinct pairs with their counts, the totals come back
by a join on the pair and are met by the block's own texts. A block keeps for each text its
distinct pairs as positions in the block's sorted list, delta-coded.

A text that is null, empty, or whose tokens do not spell its bytes has no tokens. Texts of any length
are encoded whole. Ties for the best pair of a B id all count. Repeated rows all count and each
get a row; a null id is kept; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from labweave.llm.common import in_arrow
from labweave.session import checkpoint

#: Characters of text per block and per array step.
BLOCK_CHARS = 6_000_000
STEP_CHARS = 500_000
#: Runs of white space beyond this go to the linear encoder: the other one's pattern backtracks.
LONG_RUN = 2_000
_RUN = re.compile(r"\s{%d}" % LONG_RUN)
MARK = "▁"
_ROW = 1 << 20  # piece ids are below this


class Tokens:
    """Both vocabularies: ids of texts, and the bytes of each id."""

    def __init__(self, byte_json: bytes, piece_model: bytes, pattern: str | None):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.whole = Tokenizer.from_str(byte_json.decode())
        self.whole.encode_special_tokens = True
        vocabulary = json.loads(byte_json)["model"]["vocab"]
        letters = {c: b for b, c in _byte_letters().items()}
        plain = {t: i for t, i in vocabulary.items() if all(c in letters for c in t)}
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for t, i in plain.items():
            self.a_bytes[i] = bytes(letters[c] for c in t)
        self.fast = None
        if pattern:
            import tiktoken

            special = {t["content"] for t in json.loads(byte_json).get("added_tokens", ())}
            self.fast = tiktoken.Encoding("a", pat_str=pattern, special_tokens={}, mergeable_ranks={
                self.a_bytes[i]: i for t, i in plain.items() if t not in special})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        self.b_bytes = []
        for i in range(self.pieces.get_piece_size()):
            p = self.pieces.id_to_piece(i)
            self.b_bytes.append(bytes([int(p[3:5], 16)]) if self.pieces.is_byte(i)
                                else p.replace(MARK, " ").encode())
        self.a_size = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], np.int64)

    def encode_a(self, text: str) -> list[int]:
        if self.fast is None or _RUN.search(text):
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)

    def encode(self, texts: Sequence[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids by A and by B; none where they do not spell the text."""
        b_ids = self.pieces.encode([t or "" for t in texts], num_threads=1)
        a_of, b_of = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        out_a, out_b = [], []
        for t, b in zip(texts, b_ids):
            a = self.encode_a(" " + t) if t else []
            if t:
                raw = (" " + t).encode()
                if b"".join(map(a_of, a)) != raw or b"".join(map(b_of, b)) != raw:
                    a = b = []
            out_a.append(a)
            out_b.append(b if t else [])
        return out_a, out_b


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary: printable
    Latin-1 characters stand for themselves, the other bytes in order for those from U+0100 on."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {**{b: chr(b) for b in keep}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


def shared_cuts(a_end: np.ndarray, b_end: np.ndarray, a_from: np.ndarray, b_from: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray]:
    """Borders of the leaf groups: positions in A and in B at which groups end, in order.

    ``a_end`` and ``b_end`` ascend over all texts together; ``a_from`` and ``b_from`` are the borders
    of the first intervals (texts without tokens left out), which begin and end at shared cuts.
    """
    lo_a, hi_a = a_from[:-1].copy(), a_from[1:].copy()  # interval: tokens lo .. hi - 1
    lo_b, hi_b = b_from[:-1].copy(), b_from[1:].copy()
    cut_a, cut_b = [hi_a.copy()], [hi_b.copy()]
    while len(lo_a):
        # Inner ends of A are lo .. hi - 2; B must have one too.
        on = (hi_a - lo_a > 1) & (hi_b - lo_b > 1)
        lo_a, hi_a, lo_b, hi_b = lo_a[on], hi_a[on], lo_b[on], hi_b[on]
        middle = (lo_a + hi_a - 2) // 2
        at_a, at_b = np.full(len(lo_a), -1), np.full(len(lo_a), -1)
        open_ = np.arange(len(lo_a))
        step = 0
        while len(open_):
            # Offsets 0, 1, -1, 2, -2, ... until both sides are behind the interval's inner ends.
            off = (step + 1) // 2 if step % 2 else -(step // 2)
            probe = middle[open_] + off
            inside = (probe >= lo_a[open_]) & (probe <= hi_a[open_] - 2)
            spot, who = probe[inside], open_[inside]
            found = np.searchsorted(b_end, a_end[spot])  # ends ascend, so any hit is in the interval
            hit = b_end[np.minimum(found, len(b_end) - 1)] == a_end[spot]
            at_a[who[hit]], at_b[who[hit]] = spot[hit], found[hit]
            step += 1
            reach = (step + 1) // 2
            live = (at_a[open_] < 0) & ((middle[open_] + reach <= hi_a[open_] - 2)
                                        | (middle[open_] - reach >= lo_a[open_]))
            open_ = open_[live]
        split = at_a >= 0
        at_a, at_b = at_a[split] + 1, at_b[split] + 1
        cut_a.append(at_a)
        cut_b.append(at_b)
        lo_a, hi_a = np.concatenate([lo_a[split], at_a]), np.concatenate([at_a, hi_a[split]])
        lo_b, hi_b = np.concatenate([lo_b[split], at_b]), np.concatenate([at_b, hi_b[split]])
    return np.sort(np.concatenate(cut_a)), np.sort(np.concatenate(cut_b))


class Spelling:
    """Decimal ids with their separators, by id and place: A inside a group, A at its end, then B."""

    def __init__(self, a: int, b: int):
        self.first_b = 2 * a
        self.parts = [*(f"{i}," for i in range(a)), *(f"{i}|" for i in range(a)),
                      *(f"{i}," for i in range(b)), *(f"{i};" for i in range(b))]
        self.a, self.b = a, b

    def codes(self, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> np.ndarray:
        """Places in ``parts`` of all tokens, group by group, A's ahead of B's."""
        code_a, code_b = a.copy(), b + self.first_b
        code_a[cut_a - 1] += self.a
        code_b[cut_b - 1] += self.b
        group_a = np.repeat(np.arange(len(cut_a)), np.diff(cut_a, prepend=0))
        group_b = np.repeat(np.arange(len(cut_b)), np.diff(cut_b, prepend=0))
        out = np.empty(len(a) + len(b), np.int64)
        # A token's place: its own number plus the B tokens of earlier groups; B's likewise.
        out[np.arange(len(a)) + (cut_b - np.diff(cut_b, prepend=0))[group_a]] = code_a
        out[np.arange(len(b)) + cut_a[group_b]] = code_b
        return out


def linked_pairs(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions (A, B) of all tokens that overlap: one per stretch between neighbouring ends."""
    ends = np.union1d(a_end, b_end)
    return np.searchsorted(a_end, ends), np.searchsorted(b_end, ends)


def _pack(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(x).tobytes())


def _unpack(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


class Aligner:
    """Aligned rows of some texts, and the links of each as sorted distinct pairs with their numbers."""

    def __init__(self, tokens: Tokens):
        self.tokens = tokens
        self.spelling = Spelling(len(tokens.a_bytes), len(tokens.b_bytes))

    def align(self, texts: Sequence[str | None]) -> tuple[dict[str, list], list]:
        ids_a, ids_b = self.tokens.encode(texts)
        n_a, n_b = np.array([*map(len, ids_a)], np.int64), np.array([*map(len, ids_b)], np.int64)
        a = np.fromiter((i for x in ids_a for i in x), np.int64, n_a.sum())
        b = np.fromiter((i for x in ids_b for i in x), np.int64, n_b.sum())
        rows = {"n_a": n_a, "n_b": n_b, "n_groups": np.zeros(len(texts), np.int64),
                "n_links": np.zeros(len(texts), np.int64), "groups_sha256": [""] * len(texts)}
        pairs = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(texts)
        some = np.flatnonzero(n_a)
        if not len(some):
            return rows, pairs
        # Both spell the same bytes, so one running offset serves all texts of the batch.
        a_end, b_end = np.cumsum(self.tokens.a_size[a]), np.cumsum(self.tokens.b_size[b])
        a_from = np.concatenate([[0], np.cumsum(n_a[some])])
        b_from = np.concatenate([[0], np.cumsum(n_b[some])])
        cut_a, cut_b = shared_cuts(a_end, b_end, a_from, b_from)
        groups = np.searchsorted(cut_a, a_from[1:], "right")
        rows["n_groups"][some] = np.diff(groups, prepend=0)
        codes = self.spelling.codes(a, b, cut_a, cut_b)
        parts = list(map(self.spelling.parts.__getitem__, codes.tolist()))
        x, y = linked_pairs(a_end, b_end)
        link_from = np.searchsorted(x, a_from)
        rows["n_links"][some] = np.diff(link_from)
        key = b[y] * _ROW + a[x]
        for i, row in enumerate(some.tolist()):
            said = "".join(parts[a_from[i] + b_from[i]:a_from[i + 1] + b_from[i + 1]])[:-1]
            rows["groups_sha256"][row] = hashlib.sha256(said.encode()).hexdigest()
            pairs[row] = np.unique(key[link_from[i]:link_from[i + 1]], return_counts=True)
        return rows, pairs


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Ids and texts, about STEP_CHARS characters at a time."""
    ids, texts, chars = [], [], 0
    for b in batches:
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            ids.append(doc_id)
            texts.append(text)
            chars += len(text or "") + 50
            if chars >= STEP_CHARS:
                yield ids, texts
                ids, texts, chars = [], [], 0
    if ids:
        yield ids, texts


_COUNTED = ["n_a", "n_b", "n_groups", "n_links"]


def aligned_blocks(docs: DataFrame, tokens, block_chars: int) -> DataFrame:
    """One row per block: its texts' rows, its sorted distinct pairs with their numbers of links, and
    for each text the places of its pairs in that list (gaps) with its own numbers of links."""
    src = docs.select("doc_id", "text")
    kind, id_type = dict(src.dtypes)["doc_id"], to_arrow_type(src.schema["doc_id"].dataType)
    schema = pa.schema([
        ("block", pa.int64()), ("doc_ids", pa.list_(id_type)),
        *[(c, pa.list_(pa.int64())) for c in _COUNTED], ("groups_sha256", pa.list_(pa.string())),
        ("sizes", pa.list_(pa.int32())), ("gaps", pa.binary()), ("times", pa.binary()),
        ("pairs", pa.binary()), ("links", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, name = Aligner(_tokens(tokens)), TaskContext.get().partitionId() << 32
        rows, pairs, chars = [], [], 0

        def close() -> pa.RecordBatch:
            flat = np.concatenate([p for p, _ in pairs])
            times = np.concatenate([n for _, n in pairs])
            known = np.unique(flat)
            at = np.searchsorted(known, flat)
            links = np.bincount(at, times, len(known)).astype(np.int64)
            sizes = np.array([len(p) for p, _ in pairs], np.int32)
            first = (np.cumsum(sizes) - sizes)[sizes > 0]
            gaps = np.diff(at, prepend=0)
            gaps[first] = at[first]
            out = {c: [x for r in rows for x in r[c]] for c in rows[0]}
            return pa.RecordBatch.from_pylist([{
                "block": name, **out, "sizes": sizes, "gaps": _pack(gaps.astype(np.int32)),
                "times": _pack(times.astype(np.int32)), "pairs": _pack(np.diff(known, prepend=0)),
                "links": _pack(links)}], schema)

        for ids, texts in _steps(batches):
            got, new = aligner.align(texts)
            rows.append({"doc_ids": ids, **{c: got[c].tolist() for c in _COUNTED},
                         "groups_sha256": got["groups_sha256"]})
            pairs += new
            chars += sum(len(t or "") for t in texts)
            if chars >= block_chars:
                yield close()
                rows, pairs, chars, name = [], [], 0, name + 1
        if rows:
            yield close()

    return in_arrow(src, run, f"block long, doc_ids array<{kind}>, "
                    + ", ".join(f"{c} array<bigint>" for c in _COUNTED)
                    + ", groups_sha256 array<string>, sizes array<int>, gaps binary, times binary, "
                      "pairs binary, links binary")


def block_pairs(blocks: DataFrame) -> DataFrame:
    """``block, pair, n``: the links of each block by pair (B id * 2^20 + A id)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, raw, links in zip(*(b.column(c).to_pylist() for c in b.schema.names)):
                pairs = np.cumsum(_unpack(raw, np.int64))
                yield pa.RecordBatch.from_pydict({
                    "block": np.full(len(pairs), block), "pair": pairs, "n": _unpack(links, np.int64)})

    return in_arrow(blocks.select("block", "pairs", "links"), run, "block long, pair long, n long")


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, total, best`` over the corpus: how many links have the pair, and whether no pair of
    the same B id has more."""
    totals = checkpoint(rows.groupBy("pair").agg(F.sum("n").alias("total")), "pair-totals")
    b_id = F.shiftright("pair", _ROW.bit_length() - 1)
    # One row per id of a vocabulary, which bounds the broadcast.
    top = totals.groupBy(b_id.alias("b")).agg(F.max("total").alias("top"))
    return totals.join(F.broadcast(top), b_id == F.col("b")).select(
        "pair", "total", (F.col("total") == F.col("top")).alias("best"))


def align_tokens(
    docs: DataFrame, byte_json: str, piece_model: str, *, pattern: str | None = None,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, a row per row of
    ``docs``. ``pattern`` is the byte vocabulary's split pattern; with it a faster encoder of the same
    result is used."""
    spark = docs.sparkSession
    tokens = spark.sparkContext.broadcast((_read(spark, byte_json), _read(spark, piece_model), pattern))
    blocks = checkpoint(aligned_blocks(docs, tokens, block_chars), "aligned")
    rows = block_pairs(blocks)
    known = rows.select("block", "pair").join(pair_counts(rows), "pair")
    kind, id_type = dict(docs.dtypes)["doc_id"], to_arrow_type(docs.schema["doc_id"].dataType)

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        order = np.argsort(right.column("pair").to_numpy())
        total = right.column("total").to_numpy()[order]
        best = right.column("best").to_numpy(zero_copy_only=False)[order]
        sizes = np.array(row["sizes"], np.int64)
        gaps, times = _unpack(row["gaps"], np.int32).astype(np.int64), _unpack(row["times"], np.int32)
        running = np.cumsum(gaps)
        first = np.cumsum(sizes) - sizes
        ahead = np.concatenate([[0], running])[first]
        at = running - np.repeat(ahead, sizes)
        add = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[
            np.concatenate([first, [len(x)]])])
        return pa.table({
            "doc_id": pa.array(row["doc_ids"], id_type),
            **{c: pa.array(row[c], pa.int64()) for c in _COUNTED},
            "n_best": add(np.where(best[at], times, 0).astype(np.int64)) if len(at) else 0 * sizes,
            "count_sum": add(total[at] * times) if len(at) else 0 * sizes,
            "groups_sha256": pa.array(row["groups_sha256"], pa.string())})

    columns = ["block", "doc_ids", *_COUNTED, "groups_sha256", "sizes", "gaps", "times"]
    return blocks.select(*columns).groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        count, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in _COUNTED)
        + ", n_best long, count_sum long, groups_sha256 string")


def aligned_groups(docs: DataFrame, byte_json: str, piece_model: str, *, pattern: str | None = None
                   ) -> DataFrame:
    """The groups themselves: ``doc_id, group, start, end, a_ids, b_ids`` with byte offsets in
    the text with its leading space. Texts without tokens have none."""
    spark = docs.sparkSession
    tokens = spark.sparkContext.broadcast((_read(spark, byte_json), _read(spark, piece_model), pattern))
    src = docs.select("doc_id", "text")
    kind, id_type = dict(src.dtypes)["doc_id"], to_arrow_type(src.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = _tokens(tokens)
        for ids, texts in _steps(batches):
            for doc_id, a, b in zip(ids, *t.encode(texts)):
                if not a:
                    continue
                a, b = np.array(a, np.int64), np.array(b, np.int64)
                a_end = np.cumsum(t.a_size[a])
                cut_a, cut_b = shared_cuts(a_end, np.cumsum(t.b_size[b]), np.array([0, len(a)]),
                                           np.array([0, len(b)]))
                ends = a_end[cut_a - 1]
                lists = [pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], cut]), pa.int32()), pa.array(x, pa.int32()))
                    for cut, x in ((cut_a, a), (cut_b, b))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id] * len(ends), id_type), pa.array(np.arange(len(ends))),
                     pa.array(np.concatenate([[0], ends[:-1]])), pa.array(ends), *lists],
                    names=["doc_id", "group", "start", "end", "a_ids", "b_ids"])

    return in_arrow(src, run, f"doc_id {kind}, group long, start long, end long, a_ids array<int>, "
                              "b_ids array<int>")


def _read(spark: SparkSession, path: str) -> bytes:
    """A vocabulary file (a few MB, whatever the corpus), read once by the driver."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    with open(path, "rb") as f:
        return f.read()


_parsed: dict[int, Tokens] = {}


def _tokens(data) -> Tokens:
    """Parsed once per Python worker."""
    key = data.id if hasattr(data, "id") else id(data)
    if key not in _parsed:
        _parsed.clear()
        _parsed[key] = Tokens(*data.value)
    return _parsed[key]
