"""Segmentation against the library that the model files belong to, and round trips."""

import os
import random

import pytest
from hypothesis import given, settings, strategies as st

from labweave.llm.pieces import PieceModel, decode_ids, encode_texts, piece_sizes

PATH = "/opt/tokenizers/piece_bpe_32k.model"
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary files")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def model():
    with open(PATH, "rb") as f:
        return PieceModel(f.read())


CASES = ["", " ", "a", "  a  b\n c\t", "the theory of theories", "1234567 12,5", "ß日本語 é", "a" * 300,
         "\x00\r\n", "   " * 9, "x" + " " * 40 + "y", "aaaa bbbb" * 20, "<s> </s> <unk> <0x41>"]


@pytest.mark.parametrize("text", CASES)
def test_like_the_library(model, library, text):
    (ids,) = model.encode([text], {})
    assert ids.tolist() == library.encode(text)
    assert model.decode(ids.tolist()) == text == library.decode(library.encode(text))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="▁"))
                | st.text("abehinrst .", max_size=60), max_size=5))
def test_any_text(model, library, texts):
    memo = {}
    for _ in range(2):  # the second time from the memo
        got = [i.tolist() for i in model.encode(texts, memo)]
        assert got == [library.encode(t) for t in texts]
    assert [model.decode(i) for i in got] == texts


def test_many_words(model, library):
    rng = random.Random(5)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 14))) for _ in range(20_000)]
    text = " ".join(words)
    assert model.encode([text], {})[0].tolist() == library.encode(text)


def test_unigram_is_the_best_sum(model):
    """A small unigram vocabulary against all segmentations."""
    uni = PieceModel.__new__(PieceModel)
    uni.kind, uni._pairs, uni._worst = 1, {}, -30.0
    uni.score = {"▁": -2.0, "a": -3.0, "b": -3.5, "ab": -4.0, "▁a": -4.1, "ba": -5.0, "aba": -8.2}
    uni.ids = {p: i for i, p in enumerate(uni.score)}
    uni.sizes = piece_sizes(uni.ids)
    uni.texts = list(uni.ids)

    def total(pieces):
        return sum(uni.score[p] for p in pieces)

    def all_of(w):
        if not w:
            yield []
        for n in range(1, len(w) + 1):
            if w[:n] in uni.score:
                for rest in all_of(w[n:]):
                    yield [w[:n], *rest]

    words = sorted({"▁" + "".join(w) for n in range(6) for w in
                    __import__("itertools").product("ab", repeat=n)})
    for w, got in zip(words, uni.segment_sorted(words)):
        assert "".join(got) == w
        assert total(got) == pytest.approx(max(map(total, all_of(w))))


def test_frames(spark, library):
    rows = [(1, "the cat", "x"), (2, None, "y"), (3, "", "z"), (4, "word " * 30_000, "v"),
            (4, "word " * 30_000, "v"), (None, "ünï", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = encode_texts(df, PATH)
    out = {(r.doc_id, r.n_tokens): r for r in got.collect()}
    assert len(out) == 5 and got.count() == 6
    for doc, text, _ in rows:
        want = None if text is None else library.encode(text)
        r = out[doc, None if want is None else len(want)]
        assert (r.ids if want is None else list(r.ids)) == want
        assert r.restored is (None if text is None else True)
    back = {r.doc_id: r.text for r in decode_ids(got, PATH).collect()}
    assert back == {d: t for d, t, _ in rows}
    assert encode_texts(df.limit(0), PATH).count() == 0
