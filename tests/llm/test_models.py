"""Language-model scores against dictionaries, the classifier on held-out rows, the pipeline."""

import math
import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from labweave.llm.common import crc_rest
from labweave.llm.lm_score import MU, lm_scores
from labweave.llm.quality_classifier import classify, estimate_prior, features, fit

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def lower_words(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").split(" ")


def plain_lm(rows, mu):
    """Walk each text through the automaton with dictionaries."""
    docs = [(d, train, [w for w in lower_words(t) if w] + ["</s>"]) for d, train, t in rows]
    one, two, context = Counter(), Counter(), Counter()
    for _, train, ws in docs:
        if train:
            one.update(ws)
            two.update(zip(["<s>", *ws], ws))
            context.update(["<s>", *ws[:-1]])
    n, v = sum(one.values()), len(one)
    root = lambda w: (one[w] + 0.1) / (n + 0.1 * (v + 1))
    for d, train, ws in docs:
        state, score = "<s>", 0.0
        for w in ws:
            if two[state, w]:
                score += math.log10((two[state, w] + mu * root(w)) / (context[state] + mu))
            else:  # failure arc
                score += math.log10(mu / (context[state] + mu)) + math.log10(root(w))
            state = w
        yield d, train, len(ws), sum(one[w] > 0 for w in ws), n, sum(math.log10(root(w)) for w in ws), score


@pytest.mark.parametrize("block_chars,range_keys", [(10**6, 10**6), (40, 5)])
def test_lm_scores(spark, block_chars, range_keys):
    rng = random.Random(2)
    rows = [(i, i % 3 > 0, " ".join(rng.choices(["the", "The", "cat", "sat", "on", "Ü", f"w{i}"], k=rng.randint(0, 12))))
            for i in range(60)]
    rows += [(90, True, None), (91, False, ""), (92, True, "the cat " * 5000), (5, True, "the end"), (5, True, "the end"),
             (None, False, "unseen words only")]
    df = spark.createDataFrame([(d, x, t, 1.0) for d, x, t in rows], "doc_id long, use boolean, text string, score double")
    got = lm_scores(df, F.col("use"), block_chars=block_chars, range_keys=range_keys).collect()
    key = lambda r: (str(r[0]), r[2], r[-1])
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(plain_lm(rows, MU), key=key), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:])
    assert lm_scores(df.limit(0), F.col("use")).count() == 0
    nothing = lm_scores(df, F.lit(False)).collect()  # nothing learned: one unseen type is certain
    assert all(r.n_known == 0 and r.score == pytest.approx(0) for r in nothing)


def test_states_sum_to_one():
    """Over the vocabulary and the unseen type, seen arcs and failure arc together."""
    counts, pairs, mu = {"a": 6, "b": 3, "$": 1}, {"a": 4, "b": 1}, 7.0
    n, v = 10, 3
    p = {w: (c + 0.1) / (n + 0.1 * (v + 1)) for w, c in counts.items()}
    p["unseen"] = 0.1 / (n + 0.1 * (v + 1))
    assert sum(p.values()) == pytest.approx(1)
    size = sum(pairs.values())
    assert sum((pairs.get(w, 0) + mu * q) / (size + mu) for w, q in p.items()) == pytest.approx(1)


@needs_tables
def test_lm_beats_single_words_on_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = lm_scores(docs, crc_rest(F.col("doc_id"), 10) != 0).filter("not training").agg(
        F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_risk_and_prior():
    rng = np.random.default_rng(1)
    good, bad = rng.normal(1, 1, (4000, 3)), rng.normal(-2, 1, (4000, 3))
    for share in (0.3, 0.6, 0.9):
        u = np.vstack([good[2000:2000 + int(2000 * share)], bad[:2000 - int(2000 * share)]])
        p = good[:2000]
        prior = estimate_prior(p, rng.permutation(u))
        assert prior == pytest.approx(share, abs=0.08)
        model = fit(p, u, prior)
        test = np.vstack([good[3000:], bad[3000:]])
        right = (model.score(test) >= 0.5) == np.repeat([True, False], 1000)
        assert right.mean() > 0.94


@pytest.mark.parametrize("text", [None, "", " ", "\n\n", "a", "é" * 50_000, "word " * 20_000, "\x00"])
def test_features_of_any_text(text):
    x = features(text)
    assert len(x) == 16 and all(map(math.isfinite, x))


@needs_tables
def test_classifier_on_held_out_rows(spark):
    sf = SF.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = classify(docs, labels, keep=["doc_id"]).withColumn("held", crc_rest(F.col("doc_id"), 3) == 1)
    rows = got.join(labels, "doc_id").filter("held").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    # Held-out labels and the other columns have no part in it.
    other = labels.withColumn("quality", F.when(crc_rest(F.col("doc_id"), 3) == 1, 1 - F.col("quality"))
                              .otherwise(F.col("quality")))
    moved = docs.select("doc_id", "text", F.lit("x").alias("lang"), F.lit(None).alias("source"))
    again = {r.doc_id: r.score for r in classify(moved, other).collect()}
    assert all(again[r.doc_id] == pytest.approx(r.score) for r in rows)


def test_classifier_edges(spark):
    df = spark.createDataFrame([(1, None, 2), (1, None, 2), (2, "", 3), (None, "some text", 4)],
                               "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    out = classify(df, labels).collect()
    assert len(out) == 4 and {(r.score, r.predicted) for r in out} == {(0.5, 1)}
    assert classify(df.limit(0), labels.limit(0)).count() == 0


@needs_tables
def test_pipeline_stage_by_stage(spark):
    import corpus_pipeline as cp

    from tests.llm.test_decontam import plain
    from tests.llm.test_near_dup import plain as plain_groups
    from tests.llm.test_rules import counts

    first = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs, seen = first, []
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
        seen.append(spark.createDataFrame(docs.toPandas(), docs.schema))
        docs = seen[-1]
        if name != cp.STAGES[-1][0]:
            assert docs.columns == first.columns
    text = [{r.doc_id: r.text for r in d.collect()} for d in (first, *seen[:4])]
    fine = {d for d, t in text[0].items() if (c := counts(t))[0] >= 10 and 100 * c[4] <= 20 * c[0]}
    assert text[1].keys() == fine  # no host has a frequent line that leaves too little
    assert text[2].keys() <= text[1].keys() and len(text[2]) > 0.9 * len(text[1])
    groups = plain_groups(sorted(text[2].items()))
    assert text[3].keys() == {c for _, c, _ in groups}
    assert all(plain(t, items)[1] == 0 for t in text[4].values())
    assert all(text[4][d] == t for d, t in text[3].items() if plain(t, items)[1] == 0)
    last = seen[4].collect()
    assert {r.doc_id for r in last} == text[4].keys() and all(r.restored for r in last)
    whole = cp.run(spark, SF)
    assert sorted(r.doc_id for r in whole.collect()) == sorted(r.doc_id for r in last)


@needs_tables
def test_pipeline_leaves_other_columns_alone(spark):
    """Columns of every name that a stage makes are there at the end, unchanged."""
    import corpus_pipeline as cp

    names = ["kept", "n_words", "word_chars", "n_symbols", "base_failed", "depleted", "score", "predicted",
             "was", "_row", "row", "cut", "node", "label", "hit", "doc", "host", "words", "lines", "x",
             "class_id", "n_links", "stays", "spans", "items", "ids", "restored", "_text", "_document_1"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(150)
    plain = docs
    for i, c in enumerate(names):
        docs = docs.withColumn(c, F.concat(F.lit(f"{c} {i} "), F.col("doc_id")))
    rows = {}
    for name, stage in cp.STAGES[:4]:
        docs = spark.createDataFrame(stage(spark, docs, SF).toPandas(), docs.schema)
        plain = spark.createDataFrame(stage(spark, plain, SF).toPandas(), plain.schema)
        rows = {r["doc_id"]: r for r in docs.collect()}
        assert {d: r["text"] for d, r in rows.items()} == {r["doc_id"]: r["text"] for r in plain.collect()}
    assert rows and all(r[c] == f"{c} {i} {d}" for d, r in rows.items() for i, c in enumerate(names))


def test_classifier_takes_text_ids(spark):
    rng = random.Random(4)
    rows = [(f"d{i}", " ".join(rng.choices(["the", "of", "cat", "!!", "$$"], k=30))) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    labels = spark.createDataFrame([(f"d{i}", i % 2, 0) for i in range(60)], "doc_id string, quality int, toxic int")
    assert classify(df, labels).count() == 80
    with pytest.raises(ValueError):
        classify(df.withColumn("score", F.lit(1)), labels, keep=["doc_id", "score"])
