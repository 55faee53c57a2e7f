"""The prefix trie against a plain walk over rebuilt conversations."""

import hashlib
import random
import re
import zlib

import pytest

from labweave.llm import conversation_trie as ct
from labweave.llm.conversation_trie import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256"]


def plain_trie(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    seqs = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        seqs[c] = own.get(base, [])[:h] + ts[h:]
    nodes = {}
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[:len(path)] == path]
        kids = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(q[:len(p)] == p and len(q) > len(p) for q in below)]
        saved = sum((len(nodes[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1]))
                    for p in below if p)
        ends = ",".join(str(c) for c in sorted(members) if len(seqs[c]) == len(path))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
                    len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def report(spark, rows, schema=SCHEMA):
    got = conversation_trie(spark.createDataFrame(rows, schema))
    return sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=repr)


def test_random_conversations(spark):
    rng = random.Random(3)
    texts = ["", "a b", "c\td  e", "a", "x y z", None]
    rows = [(rng.choice([*range(-25, 65), None]), rng.choice([None, 0, 1, 2, 3, 4, 5]),
             rng.choice(["user", "assistant", None]), rng.choice(texts)) for _ in range(500)]
    # Equal turn numbers have no order of their own; here they are equal rows or alone.
    once = {(c, t): (c, t, r, x) for c, t, r, x in rows}
    rows = list(once.values()) + rng.sample(list(once.values()), 40)
    assert report(spark, rows) == plain_trie(rows)


def test_one_conversation_over_many_tasks(spark):
    rows = [(20, t, "user", f"w{t % 7} x") for t in range(400)]
    rows += [(c, t, "user", f"w{t % 7} x") for c in (21, 22, 35) for t in range(c - 15)]
    rows += [(47, 0, "user", "alone")]
    assert report(spark, rows) == plain_trie(rows)


def test_many_equal_conversations(spark, monkeypatch):
    monkeypatch.setattr(ct, "PIECE_BITS", 3)  # ids in many pieces
    rows = [(c, t, "user", f"t{t}") for c in range(0, 200) for t in range(2)]
    assert report(spark, rows) == plain_trie(rows)


def test_hot_joins_are_split_alike(spark, monkeypatch):
    monkeypatch.setattr(ct, "HOT_ROWS", 3)
    rows = [(c, t, "user", "hi" if t < 2 else f"{c} {t}") for c in range(30) for t in range(5)]
    assert report(spark, rows) == plain_trie(rows)


def test_collision_is_found_and_run_again(spark, monkeypatch):
    weak = ct.bases
    monkeypatch.setattr(ct, "bases", lambda salt: (0, 0, 0, 0) if salt == 0 else weak(salt))
    # With powers of zero only a conversation's first turn counts. pow(0, -1) has no value.
    plain_pow = pow
    monkeypatch.setattr(ct, "pow", lambda b, e, p: 0 if b == 0 and e < 0 else plain_pow(b, e, p),
                        raising=False)
    rows = [(c, t, "user", f"{t} {c if t == 3 else ''}") for c in range(8) for t in range(4)]
    assert report(spark, rows) == plain_trie(rows)


def test_addresses_that_clash_are_refused(spark, monkeypatch):
    plain = ct.stored_turns
    monkeypatch.setattr(ct, "stored_turns", lambda df, salt: plain(df, salt).selectExpr(
        "conv_id", "turn", "0L x1", "0L x2", "words", "role", "text"))
    with pytest.raises(RuntimeError):
        report(spark, [(1, 0, "user", "a"), (2, 0, "user", "b")])


def test_empty_null_and_extra_columns(spark):
    assert report(spark, []) == []
    assert report(spark, [(None, 0, "user", "x")]) == []
    rows = [(1, None, None, None), (1, None, None, None), (2, 3, "user", "long " * 50_000)]
    extra = [(*r, 7, "p", 1, 2) for r in rows]
    got = report(spark, extra, SCHEMA + ", depth int, part string, x1 int, words int")
    assert got == plain_trie(rows)
