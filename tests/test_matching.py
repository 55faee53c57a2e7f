"""Name tiers against direct definitions."""

import difflib
import random

import pytest

from labweave.operators import matching, skew
from labweave.sources.config import alias_pool, dims_from_folder
from tests import sample


@pytest.fixture(scope="module")
def dims(spark, tmp_path_factory):
    return dims_from_folder(spark, sample.write_config(tmp_path_factory.mktemp("cfg")))


CASES = {
    "CLOUDINESS": ("Turbidity", "exact_alias_match"),
    "Cloudiness (by eye, second glass)": ("Turbidity", "exact_alias_match"),
    "CLOUDYNESS": ("Turbidity", "fuzzy_match"),
    "osphate": ("Phosphate", "suffix_match_truncated_name"),
    "tal hardness": ("Total Hardness", "fuzzy_match"),
    "emperature of water": ("Water Temperature", "fuzzy_match"),
    "Sampling Depth Below The": (
        "Sampling Depth Below The Water Table", "prefix_match_truncated_name"),
    "water": (None, "unresolved"),
    "grade of the ferry landing": (None, "unresolved"),
    "(second glass)": (None, "unresolved"),
    "  ": (None, "empty"),
    None: (None, "empty"),
}


def _match(spark, dims, **options):
    df = spark.createDataFrame(list(enumerate(CASES)), "i int, name string")
    out = matching.match_names(df, "name", dims, spread=["i"], **options)
    return {r["name"]: (r["canonical"], r["method"]) for r in out.collect()}


def test_tiers(spark, dims):
    assert _match(spark, dims) == CASES


def test_tiers_with_a_vocabulary_too_large_to_broadcast(spark, dims, monkeypatch):
    monkeypatch.setattr(skew, "fits_broadcast", lambda df: False)
    assert _match(spark, dims, hot_rows=1) == CASES


def _edit(rng, s):
    for _ in range(rng.randint(0, 3)):
        i = rng.randrange(len(s) + 1)
        kind = rng.random()
        s = s[:i] + (rng.choice("abc ") if kind < 0.6 else "") + s[i + (kind > 0.3):]
    return " ".join(s.split())


@pytest.mark.parametrize("threshold", [0.9, 0.8, 0.7])
def test_similarity_equals_a_scan_of_all_aliases(spark, threshold):
    """Best alias, score and confidence are those of the full comparison."""
    rng = random.Random(int(threshold * 100))
    aliases = sorted({"".join(rng.choice("abcd ") for _ in range(rng.randint(3, 22))).strip()
                      for _ in range(60)} - {""})
    aliases = [a for a in (" ".join(x.split()) for x in aliases) if a]
    names = sorted({_edit(rng, rng.choice(aliases)) for _ in range(250)} - {""})
    tests = spark.createDataFrame(
        [(i, a, "numeric", None, []) for i, a in enumerate(aliases)],
        "ord int, canonical_name string, value_type string, unit_canonical string, "
        "aliases array<string>")
    got = {
        r["name_norm"]: (r["alias_norm"], r["score"], r["confidence"])
        for r in matching.similar_matches(
            spark.createDataFrame([(n,) for n in names], "name_norm string"),
            alias_pool(tests), threshold).collect()
    }
    want = {}
    for n in names:
        scored = [(difflib.SequenceMatcher(None, a, n).ratio(), a) for a in set(aliases)]
        score, best = max(scored)
        if score >= threshold:
            want[n] = (best, score, round(difflib.SequenceMatcher(None, n, best).ratio(), 3))
    assert len(want) > 50
    assert got == want


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("threshold", [0.55, 0.7, 0.85, 1.0])
def test_edit_similarity_equals_a_scan_of_all_aliases(spark, threshold):
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abc ") for _ in range(n))
    pool = sorted({word(rng.randint(1, 14)) for _ in range(60)} | {"a", "zz"})
    names = {word(rng.randint(0, 14)) for _ in range(60)} | {"", "a", "é"}
    for p in rng.sample(pool, 30):
        i = rng.randrange(len(p))
        names |= {p[:i] + rng.choice("abx") + p[i + rng.randrange(2):]}
    want = set()
    for n in names - {""}:
        scored = [(1 - edit_distance(n, a) / max(len(n), len(a)), a) for a in pool]
        score, a = max(scored)
        if score >= threshold - 1e-9:
            want.add((n, a, edit_distance(n, a)))
    alias = spark.createDataFrame([(p, p) for p in pool], "alias_norm string, canonical string")
    got = matching.edit_matches(
        spark.createDataFrame([(n,) for n in sorted(names)], "name_norm string"), alias, threshold)
    assert {(r["name_norm"], r["alias_norm"], r["distance"]) for r in got.collect()} == want
    with pytest.raises(ValueError):
        matching.edit_candidates(got, alias, 0.5)


def test_truncation_tiers_take_the_first_alias_in_dictionary_order(spark):
    tests = spark.createDataFrame(
        [(0, "Second one alpha", []), (1, "First one alpha", ["Third one alpha"])],
        "ord int, canonical_name string, aliases array<string>"
    ).selectExpr("ord", "canonical_name", "'numeric' value_type", "null unit_canonical", "aliases")
    names = spark.createDataFrame([("d one alpha",), ("first one a",), ("one",)], "name_norm string")
    pool = alias_pool(tests)
    assert {tuple(r) for r in matching.suffix_matches(names, pool).collect()} == set()
    names = spark.createDataFrame([("econd one alpha",), ("ird one alpha",), ("first one",)],
                                  "name_norm string")
    assert {tuple(r) for r in matching.suffix_matches(names, pool).collect()} == {
        ("econd one alpha", "Second one alpha"), ("ird one alpha", "First one alpha")}
    assert {tuple(r) for r in matching.prefix_matches(names, pool).collect()} == {
        ("first one", "First one alpha")}


def test_medicines(spark, dims):
    cases = {
        "Calmex 15mg": ("Zalvorin", "brand_resolved"), "CAP. ORP 30": ("Orpanol", "brand_resolved"),
        "zalvorin": ("Zalvorin", "generic_confirmed"), "brenta": ("Brenta Salt", "brand_resolved"),
        "CAP. ORP X": ("CAP. ORP X", "unmapped_brand_or_generic"), "": (None, "missing"),
        None: (None, "missing"),
    }
    df = spark.createDataFrame([(c,) for c in cases], "m string")
    got = matching.match_medicines(df, "m", dims.medicine).collect()
    assert {r["m"]: (r["generic_name"], r["medicine_type"]) for r in got} == cases


@pytest.mark.parametrize("threshold", [0.5, 2 / 3])
def test_thresholds_that_would_pair_everything_are_refused(spark, threshold):
    names = spark.createDataFrame([("abc",)], "name_norm string")
    with pytest.raises(ValueError):
        matching.similarity_candidates(names, names, threshold)


def test_very_long_names_and_aliases(spark):
    """A page of text as a name costs nothing; a long alias is still found."""
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n)).strip()
    aliases = [" ".join(text(n).split()) for n in (12, 9, 180, 500)]
    typo = aliases[2][:90] + "zz" + aliases[2][93:]
    names = [" ".join(text(20_000).split()), typo, aliases[0][:-1] + "z", aliases[3][:250] + "zz" + aliases[3][252:]]
    tests = spark.createDataFrame(
        [(i, a, "numeric", None, []) for i, a in enumerate(aliases)],
        "ord int, canonical_name string, value_type string, unit_canonical string, aliases array<string>")
    got = {r["name_norm"]: r["alias_norm"] for r in matching.similar_matches(
        spark.createDataFrame([(n,) for n in names], "name_norm string"), alias_pool(tests)).collect()}
    want = {n: max((difflib.SequenceMatcher(None, a, n).ratio(), a) for a in aliases) for n in names[1:]}
    assert got == {n: a for n, (r, a) in want.items() if r >= 0.9} and typo in got
