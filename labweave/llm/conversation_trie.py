"""Conversation prefix trie from composable fingerprints.

Every conversation is rebuilt as a head of its base conversation's turns and then its own turns
after its head length. The rebuilt sequences are never materialised: a sequence of turns has the
fingerprint s = sum of e_i * B^i modulo a prime (i from 0, e_i the turn's content address), and
such sums form a monoid under (n, s) . (m, t) = (n + m, s + B^n * t). From the running sums of the
stored conversations the fingerprint of any rebuilt prefix follows in constant time: the base's
sum at the head's end, plus the own sums behind the own head shifted by a power of B. Four primes
below 2^31 make one fingerprint, so all products fit a 64-bit number.

Turns are ordered by a range shuffle over (conversation, turn), so a conversation of any length is
spread over tasks; each task forms running sums from its own first turn on, and the at most one
conversation per border that goes on in the next task is carried over by the same composition.

A rebuilt prefix is a place (conversation, depth); places with one fingerprint are a trie node.
Equality is verified through the stored turn references: in a node all members must have the
same parent fingerprint and the same content address of their last turn, which makes the sequences
equal by induction, and each address must stand for one (role, text) among the stored turns. If
either fails, the run is repeated with other bases and addresses.

Sums over subtrees need no recursion. A node is owned by its smallest member, and a conversation c
owns exactly its places from a depth o(c) on. So below a node v lie, member by member, the
children that begin with an owned place, one leaf for each member that owns its last place if
nobody goes on from there, and as saved words those of the places from v's depth to o(c) - 1,
which c shares with a smaller conversation.

Rows with a null (or non-numeric) conv_id belong to no conversation. Null turns come first; equal
turn numbers are ordered by content address, equal rows are as many turns; null role or text is
empty; other columns are ignored. An empty table has no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from labweave.llm.common import in_arrow, rebatched
from labweave.operators.skew import split_hot_join
from labweave.session import checkpoint

#: The largest primes below 2^31.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
#: Longest head of a rebuilt conversation, and the conversations that share a base.
MOST_HEAD = 3
FAMILY = 20
#: Conversation ids per piece of a node's id list, as a power of two.
PIECE_BITS = 12
HOT_ROWS = 200_000
SCAN_ROWS = 65_536
_MASK = (1 << 31) - 1
WORD = r"[^ \t-\r]+"


def bases(salt: int) -> tuple[int, ...]:
    rng = np.random.default_rng(1000 + salt)
    return tuple(int(rng.integers(1 << 20, p - 1)) for p in PRIMES)


def pack(s: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return (s[0] << 31) | s[1], (s[2] << 31) | s[3]


def unpack(a: int, b: int) -> list[int]:
    return [a >> 31, a & _MASK, b >> 31, b & _MASK]


def _unpacked(a: str | Column, b: str | Column) -> list[Column]:
    cols = [F.col(c) if isinstance(c, str) else c for c in (a, b)]
    return [x for c in cols for x in (F.shiftright(c, 31), c.bitwiseAND(F.lit(_MASK)))]


def _packed(s: list[Column]) -> tuple[Column, Column]:
    return (F.shiftleft(s[0], 31).bitwiseOR(s[1]), F.shiftleft(s[2], 31).bitwiseOR(s[3]))


def _mod(x: Column, j: int) -> Column:
    return F.pmod(x, F.lit(PRIMES[j]).cast("long"))


def stored_turns(conversations: DataFrame, salt: int) -> DataFrame:
    """``conv_id, turn, x1, x2, words, role, text``: the two halves of a turn's content address."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.select(
        F.col("conv_id").try_cast("long").alias("conv_id"), "turn", role.alias("role"),
        text.alias("text")).filter("conv_id is not null").select(
        "conv_id", "turn", F.xxhash64(F.lit(salt), "role", "text").alias("x1"),
        F.xxhash64("text", "role", F.lit(salt)).alias("x2"),
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("words"), "role", "text")


class RunningSums:
    """Fingerprints of the turns of one task, in order, each conversation from its first turn here."""

    def __init__(self, salt: int):
        self.bases = bases(salt)
        self.powers = [np.ones(1, np.int64) for _ in PRIMES]
        self.conv, self.count, self.words = None, 0, 0
        self.sums = [0] * len(PRIMES)

    def _power(self, j: int, up_to: int) -> np.ndarray:
        t = self.powers[j]
        while len(t) <= up_to:
            t = np.concatenate([t, t * pow(self.bases[j], len(t), PRIMES[j]) % PRIMES[j]])
        self.powers[j] = t
        return t

    def add(self, conv: np.ndarray, x1: np.ndarray, x2: np.ndarray, words: np.ndarray) -> dict:
        n = len(conv)
        new = np.empty(n, bool)
        new[0] = conv[0] != self.conv
        new[1:] = conv[1:] != conv[:-1]
        begin = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        goes_on = begin == 0 if not new[0] else np.zeros(n, bool)
        at = np.arange(n) - begin + np.where(goes_on, self.count, 0)

        def running(x: np.ndarray, carried: int) -> np.ndarray:
            total = np.cumsum(x)
            return total - (total - x)[begin] + np.where(goes_on, carried, 0)

        sums, before = [], []
        elements = [x1 & _MASK, (x1 >> 32) & _MASK, x2 & _MASK, (x2 >> 32) & _MASK]
        for j, p in enumerate(PRIMES):
            term = elements[j] % p * self._power(j, int(at.max()))[at] % p
            s = running(term, self.sums[j]) % p
            sums.append(s)
            before.append((s - term) % p)
        cum = running(words, self.words)
        self.conv, self.count, self.words = int(conv[-1]), int(at[-1]) + 1, int(cum[-1])
        self.sums = [int(s[-1]) for s in sums]
        (s1, s2), (r1, r2) = pack(sums), pack(before)
        return {"no": at + 1, "s1": s1, "s2": s2, "r1": r1, "r2": r2, "cum": cum}


def running_sums(conversations: DataFrame, salt: int) -> DataFrame:
    """One row per turn: ``conv_id, no, s1, s2, r1, r2, x1, x2, words, cum``.

    ``no`` is the turn's place in its conversation from 1, ``s`` the fingerprint of the turns up to
    it, ``r`` of those ahead of it, ``cum`` their words up to it.
    """
    spark = conversations.sparkSession
    turns = checkpoint(stored_turns(conversations, salt).select(
        "conv_id", "turn", "x1", "x2", "words", F.monotonically_increasing_id().alias("row")), "turns")
    order = ["conv_id", "turn", "x1", "x2", "row"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = ["conv_id", "x1", "x2", "words"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, part = RunningSums(salt), TaskContext.get().partitionId()
        for b in rebatched(batches, SCAN_ROWS):
            got = sums.add(*[b.column(c).to_numpy(zero_copy_only=False) for c in columns])
            yield pa.RecordBatch.from_pydict(
                {**{c: b.column(c) for c in columns}, "part": np.full(b.num_rows, part), **got})

    ranged = turns.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(*columns)
    scanned = checkpoint(ranged.mapInArrow(
        scan, "conv_id long, x1 long, x2 long, words long, part long, no long, s1 long, s2 long, "
              "r1 long, r2 long, cum long"), "running")
    carried = F.broadcast(_carried(scanned, salt))
    joined = scanned.join(carried, ["conv_id", "part"], "left")

    def whole(a: str, b: str) -> list[Column]:
        local, c, m = _unpacked(a, b), _unpacked("c1", "c2"), _unpacked("m1", "m2")
        both = _packed([_mod(c[j] + m[j] * local[j], j) for j in range(len(PRIMES))])
        return [F.when(F.col("c1").isNull(), F.col(x)).otherwise(y).alias(x)
                for x, y in zip((a, b), both)]

    none = F.lit(0).cast("long")
    return joined.select(
        "conv_id", (F.col("no") + F.coalesce("no0", none)).alias("no"), *whole("s1", "s2"),
        *whole("r1", "r2"), "x1", "x2", "words", (F.col("cum") + F.coalesce("cum0", none)).alias("cum"))


def _carried(scanned: DataFrame, salt: int) -> DataFrame:
    """``conv_id, part`` of conversations that began in an earlier part, with their turns (``no0``),
    sums (``c``), words (``cum0``) so far and the power ``m`` that shifts what follows. Parts are
    ranges, so there is at most one such row per part, which bounds what is fetched and sent."""
    spark = scanned.sparkSession
    ends = sorted(tuple(r) for r in scanned.groupBy("part").agg(
        F.min("conv_id"), F.max("conv_id")).collect())
    over = {a[2] for a, b in zip(ends, ends[1:]) if a[2] == b[1]}
    schema = "conv_id long, part long, no0 long, c1 long, c2 long, m1 long, m2 long, cum0 long"
    if not over:
        return spark.createDataFrame([], schema)
    wanted = F.broadcast(spark.createDataFrame([(c,) for c in sorted(over)], "conv_id long"))
    totals = scanned.join(wanted, "conv_id").groupBy("conv_id", "part").agg(
        F.max_by(F.struct("no", "s1", "s2", "cum"), "no").alias("t")).collect()
    out, last, n, sums, words = [], None, 0, [0] * len(PRIMES), 0
    for conv, part, t in sorted((r["conv_id"], r["part"], r["t"]) for r in totals):
        if conv != last:
            last, n, sums, words = conv, 0, [0] * len(PRIMES), 0
        power = [pow(b, n, p) for b, p in zip(bases(salt), PRIMES)]
        if n:
            out.append((conv, part, n, *map(int, pack(sums)), *map(int, pack(power)), words))
        sums = [(s + m * x) % p for s, m, x, p in zip(sums, power, unpack(t["s1"], t["s2"]), PRIMES)]
        n, words = n + t["no"], words + t["cum"]
    return spark.createDataFrame(out, schema)


def rebuilt(turns: DataFrame, salt: int) -> DataFrame:
    """One row per conversation: head length ``h``, ``k`` turns taken from the base, rebuilt ``length``
    and ``total`` words, the base's first turns, and what turns an own sum into a rebuilt one:
    fingerprint = a + B^-(h - k) * s."""
    first = F.struct("no", "s1", "s2", "r1", "r2", "x1", "x2", "words", "cum")
    own = turns.groupBy("conv_id").agg(
        F.max("no").alias("n"), F.max("cum").alias("own_words"),
        F.sort_array(F.collect_list(F.when(F.col("no") <= MOST_HEAD, first))).alias("first"))
    own = checkpoint(own.withColumns({
        "h": (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_HEAD + 1)).cast("int"),
        "base": F.col("conv_id") - F.col("conv_id") % FAMILY}), "conversations")
    base = own.filter("conv_id = base").select("base", F.col("first").alias("head"))
    both = own.join(base, "base", "left").withColumn(
        "k", F.least("h", F.coalesce(F.size("head"), F.lit(0)))).withColumns({
            "at_head": F.get("head", F.col("k") - 1),
            "at_own": F.get("first", F.col("h") - 1)})
    zero = F.lit(0).cast("long")
    field = lambda c, f: F.coalesce(F.col(c)[f], zero)
    inverse = [[pow(b, -i, p) for i in range(MOST_HEAD + 1)] for b, p in zip(bases(salt), PRIMES)]
    shift = [F.get(F.array(*[F.lit(x).cast("long") for x in inv]), F.col("h") - F.col("k"))
             for inv in inverse]
    head = _unpacked(field("at_head", "s1"), field("at_head", "s2"))
    mine = _unpacked(field("at_own", "s1"), field("at_own", "s2"))
    a = _packed([_mod(head[j] - _mod(shift[j] * mine[j], j), j) for j in range(len(PRIMES))])
    b = _packed(shift)
    # Where the own turns end within the head, there is nothing behind it.
    left = F.greatest(F.col("n") - F.col("h"), zero)
    skipped = field("at_own", "cum")
    return both.select(
        "conv_id", "n", "h", "k", F.slice("head", 1, F.col("k")).alias("head"), a[0].alias("a1"),
        a[1].alias("a2"), b[0].alias("b1"), b[1].alias("b2"), (F.col("k") + left).alias("length"),
        (field("at_head", "cum") + F.when(left > 0, F.col("own_words") - skipped).otherwise(zero)
         ).alias("total"), (field("at_head", "cum") - skipped).alias("more_words"))


_PLACE = ["conv_id", "depth", "f1", "f2", "g1", "g2", "x1", "x2", "words", "before", "length"]
_NODE = ["depth", "f1", "f2"]


def places(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """All prefixes of all rebuilt conversations: fingerprint ``f``, the parent's ``g``, the last
    turn's address ``x`` and words, and the words ``before`` it."""
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    root = convs.select(
        "conv_id", zero.alias("depth"), zero.alias("f1"), zero.alias("f2"), none.alias("g1"),
        none.alias("g2"), none.alias("x1"), none.alias("x2"), zero.alias("words"),
        zero.alias("before"), "length")
    heads = convs.select("conv_id", "length", F.explode("head").alias("t")).select(
        "conv_id", F.col("t.no").alias("depth"), F.col("t.s1").alias("f1"), F.col("t.s2").alias("f2"),
        F.col("t.r1").alias("g1"), F.col("t.r2").alias("g2"), "t.x1", "t.x2", "t.words",
        (F.col("t.cum") - F.col("t.words")).alias("before"), "length")
    known = convs.filter("n > h").select(
        "conv_id", "h", "k", "a1", "a2", "b1", "b2", "length", "more_words")
    suffix = split_hot_join(
        turns, known, ["conv_id"], convs.select("conv_id", "n"), how="inner", spread=["no"],
        hot_rows=HOT_ROWS).filter("no > h")

    def moved(x: str, y: str) -> tuple[Column, Column]:
        s, a, b = _unpacked(x, y), _unpacked("a1", "a2"), _unpacked("b1", "b2")
        return _packed([_mod(a[j] + b[j] * s[j], j) for j in range(len(PRIMES))])

    (f1, f2), (g1, g2) = moved("s1", "s2"), moved("r1", "r2")
    own = suffix.select(
        "conv_id", (F.col("no") - F.col("h") + F.col("k")).alias("depth"), f1.alias("f1"), f2.alias("f2"),
        g1.alias("g1"), g2.alias("g2"), "x1", "x2", "words",
        (F.col("cum") - F.col("words") + F.col("more_words")).alias("before"), "length")
    return root.unionByName(heads).unionByName(own).select(*_PLACE)


def _verified(nodes: DataFrame, conversations: DataFrame, salt: int) -> bool:
    """Whether every node has one parent and one last turn, and every address one content."""
    if not nodes.filter("g1_low <> g1_high or g2_low <> g2_high or x1_low <> x1_high "
                        "or x2_low <> x2_high").isEmpty():
        return False
    content = stored_turns(conversations, salt).select("x1", "x2", F.struct("role", "text").alias("t"))
    return content.groupBy("x1", "x2").agg(F.min("t").alias("a"), F.max("t").alias("b")).filter(
        "a <> b").isEmpty()


def end_digests(ends: DataFrame) -> DataFrame:
    """Per node the SHA-256 of its ``conv_id`` values, ascending, comma-joined.

    Ids are sorted and joined in pieces of 2^PIECE_BITS neighbouring ids; the pieces of a node are
    then hashed one after another as they stream by, so no list is ever held whole.
    """
    pieces = ends.groupBy(*_NODE, F.shiftright("conv_id", PIECE_BITS).alias("piece")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")),
                                 lambda x: x.cast("string")), ",").alias("ids"))
    ordered = pieces.repartition(*_NODE).sortWithinPartitions(*_NODE, "piece")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        names = [*_NODE, "ends_sha256"]
        for b in batches:
            done = []
            for *key, ids in zip(*(b.column(c).to_pylist() for c in [*_NODE, "ids"])):
                if key == node:
                    state.update(b"," + ids.encode())
                    continue
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = key, hashlib.sha256(ids.encode())
            if done:
                yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*done)))))
        if node is not None:
            yield pa.RecordBatch.from_pydict(dict(zip(names, [[x] for x in (*node, state.hexdigest())])))

    return in_arrow(ordered.select(*_NODE, "ids"), run,
                    "depth long, f1 long, f2 long, ends_sha256 string")


def conversation_trie(conversations: DataFrame, *, tries: int = 4, salt: int = 0) -> DataFrame:
    """One row per trie node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``, and the last turn's content
    address ``x1, x2``, under which ``stored_turns(conversations, salt)`` has its role and text."""
    for salt in range(salt, salt + tries):
        turns = running_sums(conversations, salt)
        convs = checkpoint(rebuilt(turns, salt), "rebuilt")
        spots = checkpoint(places(turns, convs), "places")
        bounds = [f(c).alias(f"{c}_{name}") for c in ("g1", "g2", "x1", "x2")
                  for f, name in ((F.min, "low"), (F.max, "high"))]
        nodes = checkpoint(spots.groupBy(*_NODE).agg(
            F.min("conv_id").alias("conv_id"), F.max("length").alias("deepest"),
            F.min("before").alias("before"), *bounds), "nodes")
        if _verified(nodes, conversations, salt):
            return _report(convs, spots, nodes)
    raise RuntimeError(f"fingerprints collided in {tries} runs")


def _report(convs: DataFrame, spots: DataFrame, nodes: DataFrame) -> DataFrame:
    owners = checkpoint(nodes.groupBy("conv_id").agg(
        F.count("*").alias("n"), F.min("depth").alias("first"),
        F.min_by(F.struct("before", F.col("g1_low").alias("g1"), F.col("g2_low").alias("g2")), "depth"
                 ).alias("at"),
        F.max(F.col("depth") == F.col("deepest")).alias("leaf")), "owners")
    # The node that a conversation's first owned one hangs from; the root's owner is one number.
    top = nodes.filter("depth = 0").select("conv_id").first()
    hung = owners.filter("first > 1").select(
        F.col("conv_id").alias("owner"), (F.col("first") - 1).alias("depth"),
        F.col("at.g1").alias("f1"), F.col("at.g2").alias("f2"))
    parents = split_hot_join(
        hung, nodes.select(*_NODE, F.col("conv_id").alias("parent")), _NODE,
        hung.groupBy(*_NODE).agg(F.count("*").alias("n")), spread=["owner"], hot_rows=HOT_ROWS)
    owners = checkpoint(
        owners.join(parents.select(F.col("owner").alias("conv_id"), "parent"), "conv_id", "left"
                    ).select(
            "conv_id", "n", "first", "at", "leaf",
            F.when(F.col("first") > 1, F.col("parent")).when(
                F.col("first") == 1, F.lit(top and top[0]).cast("long")).alias("parent")), "owners")
    shared = convs.select("conv_id", "length", "total").join(owners, "conv_id", "left").select(
        "conv_id", F.coalesce("first", F.col("length") + 1).alias("first"),
        F.coalesce("at.before", "total").alias("upto"), F.coalesce("leaf", F.lit(False)).alias("leaf"))
    member = split_hot_join(
        spots, shared, ["conv_id"], convs.select("conv_id", F.col("length").alias("n")),
        spread=["depth"], hot_rows=HOT_ROWS)
    long = lambda c: c.cast("long")
    below = member.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
        F.count_if((F.col("first") <= F.col("depth") + 1) & (F.col("depth") < F.col("length"))
                   ).alias("n_children"),
        F.count_if("leaf").alias("n_leaves"),
        long(F.sum(F.when(F.col("first") > F.col("depth"), F.col("upto") - F.col("before")).otherwise(0))
             ).alias("saved_tokens"),
        F.min("x1").alias("x1"), F.min("x2").alias("x2"))
    digests = end_digests(spots.filter("depth = length").select("conv_id", *_NODE))
    whole = below.join(digests, _NODE, "left")
    chain = owners.select("conv_id", "first", "parent", "n")
    out = split_hot_join(whole, chain.drop("n"), ["conv_id"], chain.select("conv_id", "n"),
                         spread=["depth"], hot_rows=HOT_ROWS)
    return out.select(
        "conv_id", "depth",
        F.when(F.col("depth") > F.col("first"), F.col("conv_id")).otherwise(F.col("parent")
                                                                            ).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        "x1", "x2")
