"""Allocation against byte-by-byte counting, spans against the library's own tokens."""

import os
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from labweave.llm.token_counts import (
    Encoder, allocate, byte_offsets, line_spans, read_ranks, token_counts,
)

PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary files")


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as f:
        return Encoder(read_ranks(f.read()))


def plain(edges, spans, rule):
    """Owner of every byte of every token."""
    counts = [0.0] * len(spans)
    for a, b in zip(edges, edges[1:]):
        share = [sum(lo <= x < hi for x in range(a, b)) for lo, hi in spans]
        if rule == "start":
            for k, (lo, hi) in enumerate(spans):
                counts[k] += lo <= a < hi
        elif rule == "split":
            for k, s in enumerate(share):
                counts[k] += s / (b - a)
        elif max(share, default=0):
            counts[share.index(max(share))] += 1
    return counts


@pytest.mark.parametrize("rule", ["majority", "start", "split"])
def test_disjoint_spans(rule):
    rng = random.Random(rule)
    for _ in range(300):
        edges = [0]
        for _ in range(rng.randint(0, 12)):
            edges.append(edges[-1] + rng.randint(1, 5))
        cuts = sorted(rng.sample(range(edges[-1] + 4), min(edges[-1] + 4, 2 * rng.randint(0, 3))))
        if rng.random() < 0.5:
            cuts = sorted({*cuts, 0, edges[-1]})
            spans = list(zip(cuts, cuts[1:]))
        else:
            spans = list(zip(cuts[::2], cuts[1::2]))
        got, _ = allocate(np.array(edges), np.array(spans, np.int64).reshape(-1, 2), rule)
        assert got.tolist() == pytest.approx(plain(edges, spans, rule))


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"])) | st.text("ab é\n\r 日"))
def test_tokens_cover_the_text(encoder, text):
    edges = encoder.edges(text)
    raw = text.encode()
    ids = encoder.encoding.encode_ordinary(text)
    assert edges[-1] == len(raw)
    assert [raw[a:b] for a, b in zip(edges, edges[1:])] == [
        encoder.encoding.decode_single_token_bytes(i) for i in ids]
    spans = np.array(line_spans(text), np.int64).reshape(-1, 2)
    assert "".join(text[a:b] for a, b in spans) == text
    at = byte_offsets(text, raw, spans)
    assert b"".join(raw[a:b] for a, b in at) == raw
    assert allocate(edges, at, "majority")[0].sum() == len(ids)


def test_frames(spark):
    rows = [(1, "one line\nanother line\n\nlast", 9), (2, None, 9), (3, "", 9), (4, "x y\n" * 20_000, 9),
            (5, "same", 9), (5, "same", 9), (None, "ü\nö", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, section int")
    out = token_counts(df, PATH).collect()
    per = {}
    for r in out:
        per.setdefault(r.doc_id, []).append(r)
    assert {k: len(v) for k, v in per.items()} == {1: 4, 4: 20_000, 5: 2, None: 2}
    for k, rs in per.items():
        rs = rs[:1] if k == 5 else rs
        assert sum(r.n_tokens for r in rs) == rs[0].doc_tokens
    assert token_counts(df.limit(0), PATH).count() == 0


def test_given_sections(spark):
    df = spark.sql("""select 1 id, 'Title here. Body of it' text,
        array(named_struct('start', 0, 'end', 11), named_struct('start', 11, 'end', 99),
              named_struct('start', 3, 'end', 3), named_struct('start', null, 'end', 3)) parts
        union all select 2, null, array(named_struct('start', 0, 'end', 5))
        union all select 3, 'no parts', null""")
    out = {(r.id, r.section): r.n_tokens for r in token_counts(
        df, PATH, id_cols=["id"], sections="parts", rule="split").collect()}
    assert out[1, 0] + out[1, 1] == pytest.approx(6) and out[1, 2] == 0
    assert out[2, 0] == 0 and out[3, 0] == 2
    with pytest.raises(ValueError):
        token_counts(df, PATH, rule="none")
