"""Links, groups and survivors against comparing all pairs."""

import random
from collections import defaultdict

import numpy as np
import pytest

from labweave.llm.near_dup import jaccard_links, keep_one, link_groups, matched_depth, near_duplicates


def sets_of(text, n=5):
    ws = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(ws[i:i + n]) for i in range(max(1, len(ws) - n + 1))} if ws else set()


def plain(rows, threshold=0.8):
    sets = [sets_of(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= threshold * len(sets[i] | sets[j]) - 1e-12:
                links[i] += 1
                links[j] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[root(i)].append(d)
    first = {r: min((x for x in v if x is not None), default=None) for r, v in ids.items()}
    return sorted(((d, first[root(i)], links[i]) for i, (d, _) in enumerate(rows)), key=str)


def made(seed, groups=12):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=4))
    texts = []
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([3, 8, 40, 120]))]
        for _ in range(rng.choice([1, 1, 2, 5])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                copy[rng.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
    texts += ["", None, "one", "One", texts[0], " "]
    rng.shuffle(texts)
    return [(100 + i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", range(3))
def test_all_pairs(spark, seed):
    rows = made(seed)
    rows.append(rows[0])
    df = spark.createDataFrame([(d, t, "n") for d, t in rows], "doc_id long, text string, node string")
    got = near_duplicates(df)
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got.collect()), key=str) == plain(rows)
    kept = keep_one(df)
    assert kept.columns == df.columns
    classes = {c for _, c, _ in plain(rows)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(classes)


def test_one_large_group(spark):
    """More near copies than a block holds, one base text, all linked."""
    rng = random.Random(3)
    base = [f"w{rng.randrange(999)}" for _ in range(300)]
    rows = []
    for i in range(700):
        copy = list(base)
        copy[rng.randrange(300)] = f"x{i}"
        rows.append((i, " ".join(copy)))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {(r.class_id, r.n_links) for r in got.collect()} == {(0, 699)}


def test_null_ids_and_empty(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f"), (None, None), (8, "")],
                               "doc_id long, text string")
    got = {(r.doc_id, r.class_id, r.n_links) for r in near_duplicates(df).collect()}
    assert got == {(None, 7, 1), (7, 7, 1), (None, None, 0), (8, 8, 0)}
    assert near_duplicates(df.limit(0)).count() == 0 and keep_one(df.limit(0)).count() == 0


def test_jaccard_at_the_threshold():
    a = np.arange(9, dtype=np.uint64)
    b = np.arange(1, 10, dtype=np.uint64)
    assert len(jaccard_links([a], [b], 0.8)[0]) == 1       # 8 of 10
    assert len(jaccard_links([a], [b], 0.81)[0]) == 0
    assert matched_depth(0.8, 0.9999) == 3 and matched_depth(0.8, 0.9) == 4


def test_groups_of_links(spark):
    rng = random.Random(1)
    links = [(i + 1, i) for i in range(50)] + [(200 + i, 100) for i in range(40)]
    links += [tuple(sorted(rng.sample(range(300, 400), 2), reverse=True)) for _ in range(60)]
    got = {r.node: r.label for r in link_groups(spark.createDataFrame(links, "a long, b long")).collect()}
    label = {n: n for e in links for n in e}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert got == label
