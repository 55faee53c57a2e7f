"""Language-model scores by a weighted backoff automaton.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` (A-Z lowered) and one end per text. The model is learned
from the training rows: every seen word is a state; a seen pair (u, v) is an arc of state u with
probability (c(uv) + mu * p(v)) / (c(u) + mu); for every other v the failure arc of u, of weight
mu / (c(u) + mu), leads to the root, whose arcs are p(v) = (c(v) + 0.1) / (N + 0.1 * (V + 1)),
an unseen word being one more type. So each state's arcs sum to one. A text is scored in one
traversal from left to right that carries the state and adds log10 probabilities.

The automaton grows with the corpus, so no task holds it whole. Texts are packed into blocks; a
block needs only the arcs that its own tokens can take. Its distinct words and pairs go, as
sorted 64-bit hashes (as gaps) with their counts in training rows, to hash ranges; each range adds up its
counts and sends back, for each block, just the totals in the block's own order. The block then
has its part of the automaton and is traversed. Blocks, and the totals, are written to the shared
folder, so a lost executor repeats one step. What is exchanged grows with the distinct words and
pairs of the blocks, a frequent one counting once per block.

Null text is empty; an empty text has its end alone; a null id counts as the empty text for the
training rule; repeated rows all count and each get a row; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from labweave.llm.common import in_arrow
from labweave.session import checkpoint

#: Characters of text per block, and hash keys per range.
BLOCK_CHARS = 8_000_000
RANGE_KEYS = 2_000_000
#: Weight of the root's distribution in a state, in counts.
MU = 30.0
ALPHA = 0.1

_UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
END, BEGIN = 0, 1  # local numbers; no word has white space, so these names are free
_NAMES = (b"\n", b"\t")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(a).tobytes())


def _unpack(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


def _pack_column(a: np.ndarray) -> bytes:
    """Numbers byte by byte: all their low bytes, then the next ones; the high ones are mostly zero."""
    a = np.ascontiguousarray(a)
    planes = a.view(np.uint8).reshape(len(a), a.itemsize).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def _unpack_column(raw: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as their gaps."""
    return _pack_column(np.diff(keys, prepend=keys[:1])) + (keys[:1] if len(keys) else np.zeros(1, np.uint64)).tobytes()


def _unpack_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpack_column(raw[:-8], np.uint64), dtype=np.uint64) + np.frombuffer(raw[-8:], np.uint64)[0]


class Block:
    """Token numbers of some texts, end to end, and the hash of each number's word."""

    def __init__(self) -> None:
        self.numbers = {name: i for i, name in enumerate(_NAMES)}
        self.ids: list = []
        self.training: list[bool] = []
        self.sizes: list[int] = []
        self.parts: list[np.ndarray] = []

    def add(self, doc_id, training: bool, text: str | None) -> None:
        number = self.numbers
        words = (text or "").encode().translate(_UPPER).split()
        part = np.empty(len(words) + 1, np.int32)
        for w in words:
            if w not in number:
                number[w] = len(number)
        part[:-1] = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
        part[-1] = END
        self.ids.append(doc_id)
        self.training.append(training)
        self.sizes.append(len(part))
        self.parts.append(part)

    def row(self) -> dict:
        sizes, training = np.array(self.sizes, np.int64), np.array(self.training)
        return {
            "doc_ids": self.ids, "training": self.training, "sizes": self.sizes,
            "tokens": _pack(np.concatenate(self.parts)),
            "words": np.array([xxhash.xxh64_intdigest(w) for w in self.numbers], np.uint64).tobytes(),
            "n_tokens": int(sizes.sum()), "train_tokens": int(sizes[training].sum()),
            "train_docs": int(training.sum()),
        }


class Packed:
    """A block's tokens with their predecessors, its distinct pairs, and both in hash order."""

    def __init__(self, row: dict):
        self.sizes = np.array(row["sizes"], np.int64)
        self.training = np.array(row["training"], bool)
        self.tokens = _unpack(row["tokens"], np.int32)
        self.words = np.frombuffer(row["words"], np.uint64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        before[self.starts] = BEGIN
        self.before = before
        code = before.astype(np.int64) * len(self.words) + self.tokens
        self.pairs, self.pair_of = np.unique(code, return_inverse=True)
        first, second = np.divmod(self.pairs, len(self.words))
        mixed = (self.words[first] ^ (self.words[first] >> np.uint64(31))) * _MIX + self.words[second]
        mixed *= _MIX
        self.pair_keys = mixed ^ (mixed >> np.uint64(29))
        self.word_order = np.argsort(self.words)
        self.pair_order = np.argsort(self.pair_keys)

    def train_counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Counts of words and of pairs in the training texts."""
        use = np.repeat(self.training, self.sizes)
        return (np.bincount(self.tokens[use], minlength=len(self.words)),
                np.bincount(self.pair_of[use], minlength=len(self.pairs)))


def _ranges(keys: np.ndarray, n: int) -> np.ndarray:
    """Borders of ``n`` equal hash ranges in sorted keys."""
    edges = np.array([((k << 64) // n) for k in range(1, n)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def packed_blocks(docs: DataFrame, training: Column, block_chars: int) -> DataFrame:
    src = docs.select("doc_id", training.alias("training"), "text")
    kind = dict(src.dtypes)["doc_id"]
    id_type = src.schema["doc_id"].dataType
    schema = pa.schema([
        ("block", pa.int64()), ("doc_ids", pa.list_(_arrow(id_type))), ("training", pa.list_(pa.bool_())),
        ("sizes", pa.list_(pa.int32())), ("tokens", pa.binary()), ("words", pa.binary()),
        ("n_tokens", pa.int64()), ("train_tokens", pa.int64()), ("train_docs", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = TaskContext.get().partitionId() << 32
        block, chars = Block(), 0

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"block": name, **block.row()}], schema)

        for b in batches:
            for doc_id, train, text in zip(*(b.column(c).to_pylist() for c in b.schema.names)):
                block.add(doc_id, train, text)
                chars += len(text or "")
                if chars >= block_chars:
                    yield close()
                    block, chars, name = Block(), 0, name + 1
        if block.ids:
            yield close()

    return in_arrow(src, run, f"block long, doc_ids array<{kind}>, training array<boolean>, "
                              "sizes array<int>, tokens binary, words binary, n_tokens long, "
                              "train_tokens long, train_docs long")


def _arrow(kind):
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _one_row(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def range_counts(blocks: DataFrame, n_ranges: int) -> DataFrame:
    """``block, range`` and the totals of that block's words and pairs in that range, in hash order;
    ``types`` counts each range's seen words once."""
    schema = "range int, block long, word_keys binary, word_counts binary, pair_keys binary, pair_counts binary"

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _one_row(batches):
            p = Packed(row)
            words, pairs = p.train_counts()
            wk, pk = p.words[p.word_order], p.pair_keys[p.pair_order]
            wc, pc = words[p.word_order], pairs[p.pair_order]
            we, pe = _ranges(wk, n_ranges), _ranges(pk, n_ranges)
            out = {"range": [], "block": [], "word_keys": [], "word_counts": [], "pair_keys": [],
                   "pair_counts": []}
            for r in range(n_ranges):
                w, q = slice(we[r], we[r + 1]), slice(pe[r], pe[r + 1])
                out["range"].append(r)
                out["block"].append(row["block"])
                out["word_keys"].append(_pack_keys(wk[w]))
                out["word_counts"].append(_pack_column(wc[w].astype(np.int64)))
                out["pair_keys"].append(_pack_keys(pk[q]))
                out["pair_counts"].append(_pack_column(pc[q].astype(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["range"], pa.int32()), pa.array(out["block"], pa.int64()),
                 *[pa.array(out[c], pa.binary()) for c in list(out)[2:]]], names=list(out))

    def totals(keys: list[bytes], counts: list[bytes]) -> tuple[list[bytes], int]:
        parts = [_unpack_keys(k) for k in keys]
        flat = np.concatenate(parts)
        _, of = np.unique(flat, return_inverse=True)
        total = np.bincount(of, np.concatenate([_unpack_column(c, np.int64) for c in counts])).astype(np.int64)
        ends = np.cumsum([len(p) for p in parts])
        return [_pack_column(x) for x in np.split(total[of], ends[:-1])], int((total > 0).sum())

    def add_up(group: pa.Table) -> pa.Table:
        words, types = totals(group.column("word_keys").to_pylist(), group.column("word_counts").to_pylist())
        pairs, _ = totals(group.column("pair_keys").to_pylist(), group.column("pair_counts").to_pylist())
        return pa.table({
            "block": group.column("block"), "range": group.column("range"),
            "word_totals": pa.array(words, pa.binary()), "pair_totals": pa.array(pairs, pa.binary()),
            "types": pa.array([types] + [0] * (group.num_rows - 1), pa.int64())})

    columns = ["block", "training", "sizes", "tokens", "words"]
    sent = in_arrow(blocks.select(*columns), send, schema)
    return sent.groupBy("range").applyInArrow(
        add_up, "block long, range int, word_totals binary, pair_totals binary, types long")


def traverse(p: Packed, words: np.ndarray, pairs: np.ndarray, n: int, types: int, train_docs: int,
             mu: float) -> dict[str, np.ndarray]:
    """Scores of a block's texts from the totals of its words and pairs.

    All texts of the block advance as arrays: the state of a position is the token ahead of it.
    """
    root = (words + ALPHA) / (n + ALPHA * (types + 1))
    state_size = words.astype(np.float64)
    state_size[END], state_size[BEGIN] = 0, train_docs
    fail = np.log10(mu / (state_size + mu))
    first, second = np.divmod(p.pairs, len(p.words))
    step = np.where(
        pairs > 0, np.log10((pairs + mu * root[second]) / (state_size[first] + mu)),
        fail[first] + np.log10(root[second]))
    add = lambda x: np.add.reduceat(x, p.starts)
    return {"n_tokens": p.sizes, "n_known": add((words[p.tokens] > 0).astype(np.int64)),
            "base_score": add(np.log10(root)[p.tokens]), "score": add(step[p.pair_of])}


def lm_scores(
    docs: DataFrame, training: Column, *, mu: float = MU, block_chars: int = BLOCK_CHARS,
    range_keys: int = RANGE_KEYS,
) -> DataFrame:
    """``doc_id, training, n_tokens, n_known, train_tokens, base_score, score``, a row per row of
    ``docs``; the model is learned where ``training`` is true."""
    spark = docs.sparkSession
    blocks = checkpoint(packed_blocks(docs, training, block_chars), "lm-blocks")
    tokens, n, train_docs = blocks.agg(*[
        F.coalesce(F.sum(c), F.lit(0)) for c in ("n_tokens", "train_tokens", "train_docs")]).first()
    n_ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-tokens // range_keys))
    counts = checkpoint(range_counts(blocks, n_ranges), "lm-counts")
    types = counts.agg(F.coalesce(F.sum("types"), F.lit(0))).first()[0]
    id_type = _arrow(docs.schema["doc_id"].dataType)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        p = Packed(row)
        right = right.sort_by("range")
        ordered = {c: np.concatenate([_unpack_column(x, np.int64) for x in right.column(c).to_pylist()])
                   for c in ("word_totals", "pair_totals")}
        words, pairs = np.empty(len(p.words), np.int64), np.empty(len(p.pairs), np.int64)
        words[p.word_order], pairs[p.pair_order] = ordered["word_totals"], ordered["pair_totals"]
        out = traverse(p, words, pairs, n, types, train_docs, mu)
        return pa.table({
            "doc_id": pa.array(row["doc_ids"], id_type), "training": pa.array(row["training"]),
            "n_tokens": out["n_tokens"], "n_known": out["n_known"],
            "train_tokens": np.full(len(p.sizes), n), "base_score": out["base_score"],
            "score": out["score"]})

    kind = dict(docs.dtypes)["doc_id"]
    return blocks.select("block", "doc_ids", "training", "sizes", "tokens", "words").groupBy(
        "block").cogroup(counts.groupBy("block")).applyInArrow(
        score, f"doc_id {kind}, training boolean, n_tokens long, n_known long, train_tokens long, "
               "base_score double, score double")
