"""N-gram Jaccard join: MinHash LSH forest, then exact verification.

A document's set holds its distinct shingles of ``words`` words (``[^\\x20\\x09-\\x0D]+``, A-Z
lowered), as 64-bit hashes; a text of fewer words is one shingle. Documents with equal sets are
one class and travel as one node, so exact copies are never paired.

Each of ``TREES`` prefix tries holds ``DEPTH`` MinHash values a node. Two nodes are candidates if
they share a prefix of the matched length in any trie. Matching starts at the whole length and
the prefix is shortened until a pair right at the threshold is found with the target recall
(:func:`matched_depth`). A trie node links its members to its smallest one; the linked groups
are then verified whole, in blocks of ``BLOCK`` nodes against blocks, each block pair a
task's row of its own: every pair of a block pair is compared by its exact shingle sets, and
what leaves the task is per node a count of links and per linked group a star of links, never the
pairs. Groups of links come from contracting those stars.

Null or empty texts have no set, no links and a class of their own. Ties: the class id is the
smallest id of its group. Repeated rows are copies of each other. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from labweave.llm.common import in_arrow, row_key, unused
from labweave.session import checkpoint

TREES = 16
DEPTH = 4
#: Nodes per block of a group that is verified.
BLOCK = 512
MEMO_WORDS = 300_000

_UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_RNG = np.random.default_rng(20)
_FACTOR = (_RNG.integers(0, 1 << 63, TREES * DEPTH, np.uint64) << np.uint64(1)) | np.uint64(1)
_SHIFT = _RNG.integers(0, 1 << 63, TREES * DEPTH, np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def matched_depth(threshold: float, recall: float, trees: int = TREES, depth: int = DEPTH) -> int:
    """Longest prefix at which a pair at the threshold meets in some trie with this recall."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def shingles(text: str | None, words: int, memo: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct hashes of a text's word n-grams."""
    ws = (text or "").encode().translate(_UPPER).split()
    if not ws:
        return np.empty(0, np.uint64)
    codes = []
    for w in ws:
        h = memo.get(w)
        if h is None:
            h = memo[w] = xxhash.xxh64_intdigest(w)
        codes.append(h)
    if len(memo) > MEMO_WORDS:
        memo.clear()
    codes = np.array(codes, np.uint64)
    n = max(1, len(codes) - words + 1)
    h = np.full(n, np.uint64(min(words, len(codes))))
    for k in range(min(words, len(codes))):
        h = (h ^ codes[k:k + n]) * _MIX
        h ^= h >> np.uint64(29)
    return np.unique(h)


def signature(s: np.ndarray) -> np.ndarray:
    """MinHash values of a non-empty set, trie after trie."""
    out = np.empty(len(_FACTOR), np.uint64)
    for k in range(len(_FACTOR)):
        out[k] = (s * _FACTOR[k] + _SHIFT[k]).min()
    return (out >> np.uint64(32)).astype(np.uint32)


def signed_rows(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, row, node, n_shingles, prints``: ``node`` is a hash of the set (null without
    words), ``prints`` the tries' prefixes of every length, as one binary."""
    src = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("row"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, int] = {}
        for b in batches:
            nodes, sizes, prints = [], [], []
            for text in b.column("text").to_pylist():
                s = shingles(text, words, memo)
                sizes.append(len(s))
                nodes.append(xxhash.xxh64_intdigest(s.tobytes()) - (1 << 63) if len(s) else None)
                prints.append(signature(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("row"), pa.array(nodes, pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(prints, pa.binary())],
                names=["doc_id", "row", "node", "n_shingles", "prints"])

    kind = dict(src.dtypes)["doc_id"]
    return in_arrow(
        src, run, f"doc_id {kind}, row long, node long, n_shingles long, prints binary")


def candidate_links(nodes: DataFrame, depth: int) -> DataFrame:
    """``a, b`` with a > b: each node and the smallest one below the same trie node."""
    size = 4 * DEPTH
    spots = nodes.select("node", F.posexplode(F.array(*[
        F.xxhash64(F.substring("prints", size * t + 1, 4 * depth)) for t in range(TREES)
    ])).alias("trie", "prefix"))
    first = spots.groupBy("trie", "prefix").agg(
        F.min("node").alias("b"), F.count("*").alias("n")).filter("n > 1")
    return spots.join(first, ["trie", "prefix"]).filter("node > b").select(
        F.col("node").alias("a"), "b").distinct()


def link_groups(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``links`` (a, b): the smallest node of its component.

    Each round points every node at its smallest neighbour, follows the pointers to their roots by
    doubling, and keeps the links between different roots. A round at least halves what is
    open, and a star is done in one.
    """
    links = checkpoint(links.filter("a <> b").distinct(), "links")
    labels = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        roots = checkpoint(both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("node"), F.least("a", "m").alias("label")), "roots")
        while True:
            up = roots.select(F.col("node").alias("label"), F.col("label").alias("next"))
            further = checkpoint(roots.join(up, "label").select("node", F.col("next").alias("label"),
                                 (F.col("next") != F.col("label")).alias("moved")), "roots")
            roots = further.drop("moved")
            if further.filter("moved").isEmpty():
                break
        if labels is None:
            labels = roots
        else:
            up = roots.select(F.col("node").alias("label"), F.col("label").alias("next"))
            labels = checkpoint(labels.join(up, "label", "left").select(
                "node", F.coalesce("next", "label").alias("label")), "labels")
        a = roots.select(F.col("node").alias("a"), F.col("label").alias("la"))
        b = roots.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        links = checkpoint(links.join(a, "a").join(b, "b").filter("la <> lb").select(
            F.col("la").alias("a"), F.col("lb").alias("b")).distinct(), "links")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels


def jaccard_links(
    a: list[np.ndarray], b: list[np.ndarray], threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of sets with at least this Jaccard similarity, exactly.

    Shared shingles are counted as a matrix product over the shingles that more than one of the
    sets has, a slice of them at a time.
    """
    sets = [*a, *b]
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, many = np.unique(flat, return_inverse=True, return_counts=True)
    every = many == len(sets)
    shared = np.full((len(a), len(b)), float(every.sum()), np.float32)
    use = (many > 1) & ~every
    number = np.cumsum(use) - 1
    keep = use[column]
    column, owner = number[column[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    width = 4096
    for lo in range(0, int(use.sum()), width):
        i, j = np.searchsorted(column, [lo, lo + width])
        dense = np.zeros((len(sets), min(width, int(use.sum()) - lo)), np.float32)
        dense[owner[i:j], column[i:j] - lo] = 1
        shared += dense[:len(a)] @ dense[len(a):].T
    both = np.rint(shared).astype(np.int64)
    union = sizes[:len(a), None] + sizes[None, len(a):] - both
    # Threshold as a fraction of whole numbers, so that a pair right at it counts.
    return np.nonzero(both * 1000 >= np.rint(threshold * 1000).astype(np.int64) * union)


def _stars(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Smallest index of each index's component under links x - y."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def verified(
    docs: DataFrame, members: DataFrame, *, words: int, threshold: float, block: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """Exact links within candidate groups: ``node, n_links`` and star links ``a, b``.

    ``members`` has ``row`` (one document of each node), ``node, label, copies``. A group of m
    nodes is dealt to ceil(m / block) blocks and every block meets every other once.
    """
    many = checkpoint(members.groupBy("label").agg(
        F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks")), "group-sizes")
    dealt = members.join(many, "label").select(
        "row", "node", "label", "copies", "blocks",
        F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))
    texts = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("row"), "text").join(
        dealt, "row")
    packed = checkpoint(_with_sets(texts.select(*_DEALT, "text"), words), "sets")
    # Block pair (i, j), i <= j: a member of block k goes to all pairs that have k.
    sent = packed.select("node", "label", "copies", "shingles", "block", F.explode(F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least(o, F.col("block")).alias("i"),
                           F.greatest(o, F.col("block")).alias("j")))).alias("pair"))

    def compare(group: pa.Table) -> pa.Table:
        nodes, once = np.unique(group.column("node").to_numpy(), return_index=True)
        group = group.take(pa.array(once))  # a repeated row brings its node again
        copies = group.column("copies").to_numpy()
        blocks = group.column("block").to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in group.column("shingles").to_pylist()]
        i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
        left, right = np.flatnonzero(blocks == i), np.flatnonzero(blocks == j)
        links = np.zeros(len(nodes), np.int64)
        star = np.arange(len(nodes))
        if len(left) and len(right):
            x, y = jaccard_links([sets[k] for k in left], [sets[k] for k in right], threshold)
            x, y = left[x], right[y]
            x, y = x[(keep := x != y)], y[keep]
            np.add.at(links, x, copies[y])
            if i != j:
                np.add.at(links, y, copies[x])
            star = _stars(len(nodes), x, y)
        on = links > 0
        return pa.table({"node": nodes[on], "n_links": links[on], "root": nodes[star[on]]})

    result = checkpoint(
        sent.select("*", "pair.i", "pair.j").drop("pair").groupBy("label", "i", "j").applyInArrow(
            compare, "node long, n_links long, root long"), "verified")
    return (result.groupBy("node").agg(F.sum("n_links").alias("n_links")),
            result.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))


_DEALT = ["node", "label", "copies", "blocks", "block"]


def _with_sets(texts: DataFrame, words: int) -> DataFrame:
    """``texts`` with the shingle set in place of the text."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, int] = {}
        for b in batches:
            sets = [shingles(t, words, memo).tobytes() for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in _DEALT], pa.array(sets, pa.binary())],
                names=[*_DEALT, "shingles"])

    return in_arrow(texts, run, "node long, label long, copies long, blocks int, block int, "
                                "shingles binary")


def near_duplicates(
    docs: DataFrame, *, words: int = 5, threshold: float = 0.8, recall: float = 0.9999
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, row, class_id, n_links, copies, n_shingles, stays``.

    ``class_id`` is the smallest doc_id of all documents connected by links (Jaccard similarity of
    at least ``threshold``), ``n_links`` the other rows that the document links to, ``copies`` the
    rows with its very set (itself included), ``stays`` is true for one row key of each class.
    """
    rows = checkpoint(signed_rows(docs, words), "signed")
    nodes = checkpoint(rows.filter("node is not null").groupBy("node").agg(
        F.count("*").alias("copies"), F.min("row").alias("row"), F.first("prints").alias("prints")),
        "nodes")
    groups = link_groups(candidate_links(nodes, matched_depth(threshold, recall)))
    members = nodes.select("node", "copies", "row").join(groups, "node")
    links, stars = verified(docs, members, words=words, threshold=threshold)
    labels = link_groups(stars)
    # All that concerns a node is gathered once; most nodes have no links.
    found = links.join(labels, "node", "left").select(
        "node", "n_links", F.coalesce("label", "node").alias("label"))
    known = nodes.select("node", "copies").join(found, "node", "left").select(
        "node", "copies", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("label", "node").alias("label"))
    first = rows.filter("node is not null").groupBy("node").agg(F.min(_order()).alias("first"))
    known = checkpoint(known.join(first, "node"), "known")
    heads = known.groupBy("label").agg(F.min("first").alias("head"))
    known = known.join(heads, "label")
    head = F.coalesce("head", _order())
    return rows.join(known, "node", "left").select(
        "doc_id", "row", F.coalesce("head.id", "doc_id").alias("class_id"),
        (F.coalesce("n_links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
        F.coalesce("copies", F.lit(1)).alias("copies"), "n_shingles",
        (head["row"] == F.col("row")).alias("stays"))


def _order():
    return F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"),
                    F.col("row").alias("row"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents (all columns) without near duplicates: one row of each class stays, the
    one with the smallest doc_id. Documents without words are not duplicates of each other, but
    equal rows are."""
    row = unused(docs, "row")
    stays = near_duplicates(docs, **options).filter("stays").select(F.col("row").alias(row))
    keyed = docs.withColumn(row, row_key(F.col("doc_id"), F.col("text")))
    return keyed.join(stays.distinct(), row, "left_semi").dropDuplicates([row]).drop(row)
