"""Token alignment against a plain model that lists every end and every overlapping pair."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from labweave.llm.token_alignment import Tokens, align_tokens, aligned_groups, shared_cuts
from labweave.llm.token_counts import PATTERN

JSON, PIECES = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    None, "", " ", "a", "▁ mark", "<|endoftext|> in text", "<s></s><unk><0x41>", "nul\x00 byte",
    "naïve café — 東京 🙂🙂 ẞ", "tabs\tand\n\nlines \r\n", "a" + " " * 5000 + "b", "    lead and trail   ",
    "don't we'll I'd", "x" * 3000, "é" * 700, "1234567890 3.14159", "same text twice", "same text twice",
    "￼�​ ", "\U0010ffff",
]


@pytest.fixture(scope="module")
def tokens():
    with open(JSON, "rb") as a, open(PIECES, "rb") as b:
        return Tokens(a.read(), b.read(), PATTERN)


def plain(tokens, texts):
    out, per_doc, total = [], [], Counter()
    for t in texts:
        a = tokens.whole.encode(" " + t, add_special_tokens=False).ids if t else []
        b = tokens.pieces.encode(t) if t else []
        raw = (" " + (t or "")).encode()
        if not t or b"".join(tokens.a_bytes[i] for i in a) != raw or b"".join(
                tokens.b_bytes[i] for i in b) != raw:
            a = b = []

        def spans(ids, of):
            at, got = 0, []
            for i in ids:
                got.append((at, at + len(of[i]), i))
                at += len(of[i])
            return got

        sa, sb = spans(a, tokens.a_bytes), spans(b, tokens.b_bytes)
        cuts = sorted({e for _, e, _ in sa} & {e for _, e, _ in sb})
        groups, i, j = [], 0, 0
        for c in cuts:
            left, right = [], []
            while i < len(sa) and sa[i][1] <= c:
                left.append(str(sa[i][2]))
                i += 1
            while j < len(sb) and sb[j][1] <= c:
                right.append(str(sb[j][2]))
                j += 1
            groups.append(",".join(left) + "|" + ",".join(right))
        if len(sa) < 300:
            links = [(x[2], y[2]) for x in sa for y in sb if x[0] < y[1] and y[0] < x[1]]
        else:  # the same by merging
            links, i, j = [], 0, 0
            while i < len(sa) and j < len(sb):
                links.append((sa[i][2], sb[j][2]))
                ea, eb = sa[i][1], sb[j][1]
                i, j = i + (ea <= eb), j + (eb <= ea)
        total.update(links)
        per_doc.append(links)
        out.append([len(a), len(b), len(groups), len(links), 0, 0,
                    hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""])
    top = {}
    for (_, b), n in total.items():
        top[b] = max(top.get(b, 0), n)
    for row, links in zip(out, per_doc):
        row[4] = sum(total[p] == top[p[1]] for p in links)
        row[5] = sum(total[p] for p in links)
    return out


def made(n, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "Ungheiten", "éêeux", "entekeitö", "x1y2", "ing", "—", "www.a-b.org/q?x=1"]) \
        + rng.choice(["", ",", ".", "s", "\n", "  ", "ung"])
    return [" ".join(word() for _ in range(rng.randrange(120))) for _ in range(n)]


def test_against_plain_model(spark, tokens):
    texts = ODD + made(60, 1)
    rows = [(i if i != 3 else None, t, "en", 1, 2, "x") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_a int, pair int, block string")
    got = align_tokens(df.repartition(3), JSON, PIECES, pattern=PATTERN, block_chars=4000).collect()
    want = plain(tokens, texts)
    assert len(got) == len(texts)
    by_id = {r["doc_id"]: [r[c] for c in COLUMNS] for r in got}
    for i, w in enumerate(want):
        assert by_id[i if i != 3 else None] == w, (i, texts[i][:40] if texts[i] else texts[i])


def test_both_encoders_agree(tokens):
    for t in ODD + made(200, 2):
        if t:
            assert tokens.encode_a(" " + t) == tokens.whole.encode(
                " " + t, add_special_tokens=False).ids


def test_block_size_does_not_matter(spark):
    df = spark.createDataFrame(list(enumerate(made(40, 3))), "doc_id int, text string")
    one = align_tokens(df, JSON, PIECES, pattern=PATTERN)
    many = align_tokens(df, JSON, PIECES, block_chars=500)
    key = lambda r: r["doc_id"]
    assert sorted(one.collect(), key=key) == sorted(many.collect(), key=key)


def test_very_long_text_and_text_ids(spark, tokens):
    texts = ["abcde" * 20_000, " ".join(made(300, 4))]
    df = spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "doc_id string, text string")
    got = sorted(align_tokens(df, JSON, PIECES, pattern=PATTERN).collect(), key=lambda r: r["doc_id"])
    assert [[r[c] for c in COLUMNS] for r in got] == plain(tokens, texts)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert align_tokens(df, JSON, PIECES).count() == 0
    assert aligned_groups(df, JSON, PIECES).count() == 0


def test_groups_spell_the_text(spark, tokens):
    text = made(1, 5)[0]
    df = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    rows = sorted(aligned_groups(df, JSON, PIECES).collect(), key=lambda r: r["group"])
    raw = (" " + text).encode()
    assert rows[0]["start"] == 0 and rows[-1]["end"] == len(raw)
    for r in rows:
        for ids, of in ((r["a_ids"], tokens.a_bytes), (r["b_ids"], tokens.b_bytes)):
            assert b"".join(of[i] for i in ids) == raw[r["start"]:r["end"]]


def test_cuts_of_random_ends():
    rng = np.random.default_rng(1)
    for _ in range(200):
        end = int(rng.integers(1, 60))
        a, b = (np.unique(np.append(rng.integers(1, end + 1, int(rng.integers(1, 40))), end)) for _ in range(2))
        cut_a, cut_b = shared_cuts(a, b, np.array([0, len(a)]), np.array([0, len(b)]))
        want = np.intersect1d(a, b)
        assert (a[cut_a - 1] == want).all() and (b[cut_b - 1] == want).all()
