"""SimHash components against all pairs of fingerprints."""

import random
import re

import numpy as np
import pytest
import xxhash

from labweave.llm import simhash_cover as sc
from labweave.llm.near_dup import link_groups
from labweave.llm.simhash_cover import CODES, Cover, near_links, simhash_components


def plain_print(text):
    ws = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not ws:
        return 0
    grams = [" ".join(ws[i:i + 4]) for i in range(max(1, len(ws) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits=4):
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def clouds(seed, centres, around):
    """Fingerprints, many within a few bits of each other, some in chains."""
    rng, out = random.Random(seed), set()
    for _ in range(centres):
        x = rng.getrandbits(64)
        for _ in range(around):
            y = x
            for b in rng.sample(range(64), rng.randrange(0, 7)):
                y ^= 1 << b
            out.add(y)
            if rng.random() < 0.3:
                x = y
    return sorted(out)


@pytest.mark.parametrize("code", CODES)
def test_code_covers(code):
    cover = Cover(code, 2)
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 32, 300, np.uint64)
    home = cover.home(x)
    assert (cover.home(home) == home).all()  # anchors are at home at themselves
    assert len(home) == len(x)
    for flips in (1, 2):
        y = x.copy()
        for _ in range(flips):
            y ^= np.uint64(1) << rng.integers(0, 32, len(x)).astype(np.uint64)
        who, anchor = cover.near(y)
        met = {(int(w), int(a)) for w, a in zip(who, anchor)}
        assert len(met) == len(who)
        assert all((i, int(h)) in met for i, h in enumerate(home))


@pytest.mark.parametrize("code", CODES)
@pytest.mark.parametrize("block", [8, 4096])
def test_links_equal_all_pairs(spark, code, block):
    prints = clouds(5, 25, 12) + [0, 1, (1 << 64) - 1]
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = link_groups(near_links(df, code=code, block=block)).collect()
    label = {r["node"]: r["label"] for r in got}
    groups = {}
    for p, root in zip(signed, plain_components(prints)):
        groups.setdefault(root, set()).add(p)
    for g in groups.values():
        assert len({label.get(p, p) for p in g}) == 1
    assert len({label.get(p, p) for p in signed}) == len(groups)


def texts(seed, n):
    rng, out = random.Random(seed), []
    for _ in range(n):
        ws = [rng.choice(["Ab", "cd", "É", "x,", "Y" * 3, "z1"]) + str(rng.randrange(30))
              for _ in range(rng.choice([0, 1, 3, 4, 40, 200]))]
        out.append(" ".join(ws))
        for _ in range(rng.randrange(3)):
            ws = list(ws)
            if ws:
                ws[rng.randrange(len(ws))] = "new"
            out.append(rng.choice(["\t", "  ", "\n"]).join(ws))
    return out


def test_documents_against_plain_model(spark, monkeypatch):
    monkeypatch.setattr(sc, "HOT_ROWS", 2)
    ts = [None, "", " \n", "ONE", "one", "word " * 60_000, "x" * 400_000, *texts(1, 60)]
    rows = [(i, t, 1, 2, "c") for i, t in enumerate(ts)] + [(5, ts[5], 1, 2, "c"), (None, "one", 0, 0, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int, key int, label string")
    got = simhash_components(df.repartition(4)).collect()
    assert len(got) == len(rows)
    prints = [plain_print(r[1]) for r in rows]
    root = plain_components(prints)
    least = {}
    for r, k in zip(rows, root):
        if r[0] is not None:
            least[k] = min(least.get(k, r[0]), r[0])
    want = sorted((repr(r[0]), f"{p:016x}", least.get(k)) for r, p, k in zip(rows, prints, root))
    assert sorted((repr(r[0]), r[1], r[2]) for r in got) == want


def test_empty_table(spark):
    assert simhash_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_text_ids(spark):
    df = spark.createDataFrame([("b", "q w e r t"), ("a", "q w e r t"), ("c", "other")], "doc_id string, text string")
    assert sorted((r[0], r[2]) for r in simhash_components(df).collect()) == [
        ("a", "a"), ("b", "a"), ("c", "c")]
