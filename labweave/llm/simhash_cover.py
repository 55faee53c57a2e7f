"""SimHash near-duplicates by anchor-point covering.

A text's fingerprint has a bit set where more than half of its word shingles' 64-bit hashes have it.
Two fingerprints link at ``bits`` (4) or fewer differing bits, so one of their 32-bit halves has at
most t = bits / 2 differing ones. For each half a covering code is chosen, a product of perfect
codes and free bits: its codewords are the anchors, and every word has exactly one anchor, its home,
within the covering radius of each factor. If x and y differ in at most t bits of a half, y lies
within radius + t of x's home, the t shared out among the factors. So each fingerprint is
replicated to all anchors within that distance, and at each anchor the fingerprints at home
there are compared, all 64 bits, with everything that arrived. Nothing is missed.

Finer codes have more anchors, fewer fingerprints at each, and more replicas: ``anchor_code`` picks
one by the number of distinct fingerprints. The links found do not depend on it.

Equal fingerprints travel once. Replicas are shuffled by anchor and sorted, so a task streams
through its anchors and holds a bounded batch. An anchor with far more replicas than usual is dealt to
pairs of blocks. What leaves a batch are stars over the linked fingerprints, not pairs. Components
come from contracting them.

Null or empty texts, or those without a word, have fingerprint zero, linked like any other. A text
with fewer words than a shingle is one shingle. Ties (exactly half) leave a bit unset; the component
is named by its smallest doc_id (null if it has none). Repeated rows share a component; other
columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from labweave.llm.common import in_arrow, rebatched
from labweave.llm.near_dup import link_groups
from labweave.operators.skew import split_hot_join
from labweave.session import checkpoint
from labweave.sources.config import broadcast_if_small

SEED = 42
BITS = 4
WORDS = 4
#: Fingerprints expanded, replicas compared, and pairs held at once.
EXPAND_ROWS = 8_192
COMPARE_ROWS = 200_000
PAIR_ROWS = 4_000_000
#: Replicas at an anchor beyond which it is dealt to blocks, if that is also many times the mean.
BLOCK = 4_096
HOT_ROWS = 200_000
_HASHES = 1 << 16
_UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_hashes(text: str | None, words: int = WORDS) -> np.ndarray:
    """XXH64 of each shingle of the text, repeats included."""
    ws = (text or "").encode().translate(_UPPER).split()
    if not ws:
        return np.empty(0, np.uint64)
    joined, digest = b" ".join(ws), xxhash.xxh64_intdigest
    size = np.fromiter(map(len, ws), np.int64, len(ws))
    end = np.cumsum(size + 1) - 1
    n = max(1, len(ws) - words + 1)
    first, last = (end - size)[:n].tolist(), end[min(words, len(ws)) - 1:].tolist()
    return np.fromiter((digest(joined[i:j], SEED) for i, j in zip(first, last)), np.uint64, n)


def fingerprint(hashes: np.ndarray) -> int:
    """The majority bits, as a signed 64-bit number."""
    count = np.zeros(64, np.int64)
    for k in range(0, len(hashes), _HASHES):
        part = hashes[k:k + _HASHES].astype("<u8").view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    packed = np.packbits(2 * count > len(hashes), bitorder="little")
    return int(packed.view("<i8")[0])


class Factor:
    """One factor of a covering code: ``size`` bits from ``at`` on, the syndrome of each bit, and by
    syndrome the changes that lead to codewords within the covering radius + ``reach``, nearest
    first. ``cost`` is what a change uses of ``reach``."""

    def __init__(self, at: int, syndromes: list[int], reach: int):
        self.at, self.syndromes = at, syndromes
        size, states = len(syndromes), max(syndromes) + 1 if any(syndromes) else 1
        states = 1 << (states - 1).bit_length()
        nearest: dict[int, int] = {}
        found: list[list[tuple[int, int]]] = [[] for _ in range(states)]
        radius = weight = 0
        while len(nearest) < states or weight <= radius + reach:
            for bits in combinations(range(size), weight):
                s = change = 0
                for b in bits:
                    s ^= syndromes[b]
                    change |= 1 << b
                if s not in nearest:
                    nearest[s] = radius = weight
                found[s].append((weight, change))
            weight += 1
        rows = [(s, max(0, w - radius), c) for s, x in enumerate(found) for w, c in x if w <= radius + reach]
        self.radius = radius
        self.cost = np.array([r[1] for r in rows], np.int64)
        self.change = np.array([r[2] for r in rows], np.uint64) << np.uint64(at)
        state = np.array([r[0] for r in rows])
        self.start = np.searchsorted(state, np.arange(states))
        #: Changes by state within a cost: rows of a state come in order of weight.
        self.within = np.stack([np.bincount(state[self.cost <= c], minlength=states)
                                for c in range(reach + 1)], axis=1)

    def state(self, half: np.ndarray) -> np.ndarray:
        out = np.zeros(len(half), np.int64)
        for i, s in enumerate(self.syndromes):
            if s:
                out ^= ((half >> np.uint64(self.at + i)) & np.uint64(1)).astype(np.int64) * s
        return out


def _golay() -> list[int]:
    """Syndromes of the binary Golay code of length 23: powers of x modulo its polynomial."""
    out, x = [], 1
    for _ in range(23):
        out.append(x)
        x <<= 1
        if x >> 11:
            x ^= 0b110001110101
    return out


def _hamming(r: int) -> list[int]:
    return list(range(1, 1 << r))


#: Factors of the codes for a half, coarse to fine; [0] is a free bit.
CODES = {
    "golay": [_golay(), _hamming(3), [0], [0]],
    "hamming15": [_hamming(4), _hamming(4), [0], [0]],
    "hamming31": [_hamming(5), [0]],
}


def anchor_code(points: int) -> str:
    return "golay" if points <= 50_000_000 else "hamming15" if points <= 2_000_000_000 else "hamming31"


class Cover:
    """Anchors of 32-bit halves."""

    def __init__(self, code: str, reach: int):
        self.reach, self.factors, at = reach, [], 0
        for syndromes in CODES[code]:
            self.factors.append(Factor(at, syndromes, reach))
            at += len(syndromes)
        self.anchors = 1 << at
        for f in self.factors:
            self.anchors //= len(f.start)

    def near(self, half: np.ndarray, reach: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``half`` and the anchors within the radius + ``reach`` of each."""
        who, anchor = np.arange(len(half)), half.copy()
        left = np.full(len(half), self.reach if reach is None else reach)
        for f in self.factors:
            state = f.state(half)
            many = f.within[state[who], left]
            nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            who, anchor, left = (np.repeat(x, many) for x in (who, anchor, left))
            pick = f.start[state[who]] + nth
            anchor, left = anchor ^ f.change[pick], left - f.cost[pick]
        return who, anchor

    def home(self, half: np.ndarray) -> np.ndarray:
        return self.near(half, 0)[1]


_HALF = np.uint64(0xFFFFFFFF)


def replicas(points: np.ndarray, cover: Cover) -> tuple[np.ndarray, np.ndarray]:
    """``anchor`` (half * 2^32 + word) and fingerprint of all replicas."""
    keys, who = [], []
    for half in (0, 1):
        word = (points >> np.uint64(32 * half)) & _HALF
        w, anchor = cover.near(word)
        who.append(w)
        keys.append((anchor | (np.uint64(half) << np.uint64(32))).view(np.int64))
    return np.concatenate(keys), points[np.concatenate(who)]


def linked(key: np.ndarray, points: np.ndarray, cover: Cover, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Star links of whole anchors; rows of an anchor lie together. Every fingerprint at home is
    compared with all of its anchor."""
    begin = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)])) \
        if key.ndim > 1 else np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(begin, len(points)))
    anchor = key[:, 0] if key.ndim > 1 else key
    half = (anchor >> 32).astype(np.uint64)
    word = (points >> (half * np.uint64(32))) & _HALF
    home = cover.home(word) == (anchor.view(np.uint64) & _HALF)
    segment = np.repeat(np.arange(len(begin)), size)
    rows = np.flatnonzero(home & (size[segment] > 1))
    many = size[segment[rows]]
    upto = np.cumsum(many)
    values, number = np.unique(points, return_inverse=True)
    label = np.arange(len(values))
    at = 0
    while at < len(rows):
        till = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIR_ROWS, "right")))
        part, m = rows[at:till], many[at:till]
        x = np.repeat(part, m)
        y = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(begin[segment[part]], m)
        near = np.bitwise_count(points[x] ^ points[y]) <= bits
        label = _joined(label, number[x[near]], number[y[near]])
        at = till
    off = label != np.arange(len(values))
    return values[off].view(np.int64), values[label[off]].view(np.int64)


def _joined(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``label`` (each one's smallest fellow so far) with the links x - y added."""
    while len(x):
        a, b = label[x], label[y]
        open_ = a != b
        x, y, a, b = x[open_], y[open_], a[open_], b[open_]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]
    return label


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, fp`` of every row."""
    src = docs.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [fingerprint(shingle_hashes(t, words)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(got, pa.int64())], names=["doc_id", "fp"])

    return in_arrow(src, run, f"doc_id {dict(src.dtypes)['doc_id']}, fp long")


def _expanded(points: DataFrame, code: str, reach: int, count: bool) -> DataFrame:
    """All replicas ``key, fp``, or with ``count`` their number by anchor and step ``key, n``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cover = Cover(code, reach)
        for b in rebatched(batches, EXPAND_ROWS):
            fps = b.column("fp").to_numpy().view(np.uint64)
            for k in range(0, len(fps), EXPAND_ROWS):
                key, fp = replicas(fps[k:k + EXPAND_ROWS], cover)
                if count:
                    key, n = np.unique(key, return_counts=True)
                yield pa.RecordBatch.from_pydict(
                    {"key": key, **({"n": n} if count else {"fp": fp.view(np.int64)})})

    return in_arrow(points.select("fp"), run, "key long, n long" if count else "key long, fp long")


def near_links(points: DataFrame, *, bits: int = BITS, code: str | None = None, block: int = BLOCK
               ) -> DataFrame:
    """Links ``a, b`` that join all fingerprints (``fp``, distinct) within ``bits`` of each other."""
    n = points.count()
    code, reach = code or anchor_code(n), bits // 2
    cover = Cover(code, reach)
    at_anchor = _expanded(points, code, reach, True).groupBy("key").agg(F.sum("n").alias("n"))
    at_anchor = checkpoint(at_anchor.filter(F.col("n") > block), "large-anchors")
    total = replicas(np.arange(256, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), cover)[0].size / 256
    most = max(block, int(8 * total * n / (2 * cover.anchors)))
    hot = at_anchor.filter(F.col("n") > most).select(
        F.col("key").alias("hot"), F.ceil(F.col("n") / F.lit(most)).cast("int").alias("blocks"))
    sent = _expanded(points, code, reach, False)
    keys = ["key"]
    if not hot.isEmpty():
        keys = ["key", "i", "j"]
        mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        sent = sent.join(broadcast_if_small(hot), F.col("key") == F.col("hot"), "left").select(
            "key", "fp", F.coalesce("blocks", F.lit(1)).alias("blocks")).select(
            "key", "fp", F.explode(F.transform(
                F.sequence(F.lit(0), F.col("blocks") - 1),
                lambda o: F.struct(F.least(o, mine).alias("i"), F.greatest(o, mine).alias("j"))
            )).alias("p")).select("key", "fp", "p.i", "p.j")
    sorted_ = sent.repartition(*keys).sortWithinPartitions(*keys)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cover = Cover(code, reach)
        rest_key, rest_fp = np.empty((0, len(keys)), np.int64), np.empty(0, np.uint64)

        def done(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            if len(fp):
                a, b = linked(key if len(keys) > 1 else key[:, 0], fp, cover, bits)
                if len(a):
                    yield pa.RecordBatch.from_pydict({"a": a, "b": b})

        for batch in rebatched(batches, COMPARE_ROWS):
            key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in keys], axis=1)
            key = np.concatenate([rest_key, key])
            fp = np.concatenate([rest_fp, batch.column("fp").to_numpy().view(np.uint64)])
            # The last anchor may go on in the next batch.
            cut = int(np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))[-1])
            yield from done(key[:cut], fp[:cut])
            rest_key, rest_fp = key[cut:], fp[cut:]
        yield from done(rest_key, rest_fp)

    return in_arrow(sorted_, compare, "a long, b long")


def simhash_components(
    docs: DataFrame, *, bits: int = BITS, words: int = WORDS, code: str | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """``doc_id, fingerprint, component_id``, a row per row of ``docs``."""
    rows = checkpoint(fingerprints(docs, words), "fingerprints")
    points = checkpoint(rows.groupBy("fp").agg(
        F.min("doc_id").alias("head"), F.count("*").alias("n")), "points")
    labels = link_groups(near_links(points, bits=bits, code=code, block=block)).select(
        F.col("node").alias("fp"), "label")
    known = checkpoint(labels.join(points.select("fp", "head"), "fp"), "linked")
    heads = known.groupBy("label").agg(F.min("head").alias("least"), F.count("*").alias("n"))
    heads = checkpoint(heads, "heads")
    least = split_hot_join(known.select("fp", "label"), heads.drop("n"), ["label"],
                           heads.select("label", "n"), spread=["fp"], hot_rows=HOT_ROWS)
    whole = checkpoint(points.join(least.select("fp", "least"), "fp", "left").select(
        "fp", F.coalesce("least", "head").alias("component_id"), "n"), "components")
    out = split_hot_join(rows, whole.drop("n"), ["fp"], whole.select("fp", "n"),
                         spread=["doc_id"], hot_rows=HOT_ROWS)
    return out.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
