"""The index against plain scanning of every text."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from labweave.llm.decontam import (
    Phrases, ShardIndex, clean_text, digest, find_in_shard, find_items, merge_spans, remove_items,
    suffix_order, without_spans,
)

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def plain(text, items, window=10):
    words, hit, names = WORD.findall(lower(text)), set(), set()
    for name, item in items:
        ws = WORD.findall(lower(item))
        for i in range(max(1, len(ws) - window + 1) if ws else 0):
            w = ws[i:i + window]
            for j in range(len(words) - len(w) + 1):
                if words[j:j + len(w)] == w:
                    hit.update(range(j, j + len(w)))
                    names.add(str(name))
    return len(words), len(hit), sorted(names)


@pytest.mark.parametrize("seed", range(6))
def test_suffixes_search_and_locate(seed):
    rng = np.random.default_rng(seed)
    s = np.concatenate([rng.integers(1, 4 + seed, 300), np.full(40, 2), [0]])
    order = suffix_order(s)
    assert order.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
    index = ShardIndex(s, 12)
    for size in (1, 2, 3, 7):
        phrases = np.array([s[i:i + size] for i in range(0, 300, 3)] + [[11] * size])
        lo, hi = index.search(phrases)
        for p, a, b in zip(phrases, lo, hi):
            want = [i for i in range(len(s) - size + 1) if (s[i:i + size] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


@pytest.mark.parametrize("seed", range(8))
def test_random_shards(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("ab c d e f g".split() + ["X1", "ü"])
    items = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 2, 4, 12, 15])))) for i in range(6)]
    texts = [" ".join(word() for _ in range(rng.randint(0, 60))) for _ in range(30)]
    texts += [f"zz, {t}. {u}-q" for (_, t), u in zip(items, texts)] + [None, "", texts[3] * 20]
    for window in (3, 10):
        phrases = Phrases([(str(i), t) for i, t in items], window)
        sizes, hits = find_in_shard(texts, phrases)
        for d, t in enumerate(texts):
            spans, names = hits.get(d, ([], set()))
            assert (sizes[d], sum(b - a for a, b in spans), sorted(names)) == plain(t, items, window)


def test_merge_and_cut():
    assert merge_spans([(5, 7), (0, 2), (2, 3), (6, 9)]) == [(0, 3), (5, 9)]
    assert without_spans("A b, c! d e.", [(1, 3)]) == "A ! d e."
    assert without_spans("A b", []) == "A b"


def frames(spark):
    phrase = "one two three four five six seven eight nine ten eleven"
    docs = [(1, f"Start. {phrase.upper()}, end", "x"), (2, "nothing here", "y"), (3, None, None),
            (4, "", "z"), (5, "short item", "x"), (5, "short item", "x"), (None, phrase, "n"),
            (6, "filler " * 50_000 + phrase, "long")]
    items = [(10, phrase, 1), (10, phrase, 2), (11, "short item", 3), (12, None, 4), (None, "end", 5),
             (13, "...", 6)]
    return (spark.createDataFrame(docs, "doc_id long, text string, items string"), docs,
            spark.createDataFrame(items, "item_id long, text string, n_words int"), items)


@pytest.mark.parametrize("max_chars", [10**6, 60])
def test_frames(spark, max_chars):
    docs, rows, items, item_rows = frames(spark)
    got = digest(find_items(docs, items, max_chars=max_chars))
    real = [(str(i), t) for i, t, _ in item_rows if i is not None and t]
    want = []
    for doc, text, _ in rows:
        n, hit, names = plain(text, real)
        want.append((doc, n, hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), hit > 0))
    key = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("max_chars", [10**6, 60])
def test_removal_leaves_nothing(spark, max_chars):
    docs, rows, items, _ = frames(spark)
    cut = remove_items(docs, items, max_chars=max_chars)
    assert cut.columns == docs.columns and cut.count() == len(rows)
    assert digest(find_items(cut, items)).filter("contaminated").count() == 0
    assert {r.text for r in cut.filter("doc_id in (2, 3, 4)").collect()} == {"nothing here", None, ""}
    assert {r.text for r in cut.filter("doc_id = 1").collect()} == {"Start. , end"}


def test_blocks_do_not_change_the_result(spark):
    """Overlapping windows of two blocks, and phrases that the other block's removal joins."""
    run = lambda a, b: " ".join(f"w{i}" for i in range(a, b))
    a, b, p = run(1, 11), run(6, 16), run(50, 60)
    docs = spark.createDataFrame(
        [(1, f"x {run(1, 16)} y"), (2, f"x {run(1, 6)} {p} {run(6, 11)} y"),
         (3, f"x {run(50, 55)} {a} {run(55, 60)} y"), (4, "clean"), (5, None), (1, f"x {run(1, 16)} y")],
        "doc_id long, text string")
    items = spark.createDataFrame([(10, a), (11, b), (12, p)], "item_id long, text string")
    for max_chars in (10**6, 70, 30):
        got = sorted((r.doc_id, r.text and r.text.split()) for r in
                     remove_items(docs, items, max_chars=max_chars).collect() if r.text)
        assert got == [(1, ["x", "y"]), (1, ["x", "y"]), (2, ["x", "y"]), (3, ["x", "y"]), (4, ["clean"])]
        assert remove_items(docs, items, max_chars=max_chars).count() == 6


def test_only_emptied_texts_are_dropped(spark, tmp_path):
    from corpus_pipeline import decontamination_stage

    phrase = " ".join(f"w{i}" for i in range(10))
    spark.createDataFrame([(1, phrase)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(
        [(1, "... !!! ??? --- *** ///"), (2, f"- {phrase} -"), (3, f"a {phrase}"), (4, "clean")], "doc_id long, text string")
    out = decontamination_stage(spark, docs.withColumn("n_chars", F.length("text").cast("long")), str(tmp_path))
    assert {r.doc_id: r.text for r in out.collect()} == {1: "... !!! ??? --- *** ///", 3: "a ", 4: "clean"}


def test_removal_closes_a_gap():
    phrases = Phrases([("1", "a b c")], 10)
    assert clean_text("x a a b c b c y", phrases).split() == ["x", "y"]


def test_empty(spark):
    docs, _, items, _ = frames(spark)
    assert find_items(docs.limit(0), items).count() == 0
    assert digest(find_items(docs, items.limit(0))).filter("contaminated").count() == 0
