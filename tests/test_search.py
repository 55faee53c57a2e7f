"""Indexed search against a scan of all rows."""

import random

import pytest

from labweave.operators.search import build_index, candidates, search_index, term_grams

COLUMNS, SEARCHED = ["doc", "name", "town"], ["doc", "name"]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rng = random.Random(6)
    part = lambda: "".join(rng.choice("abÄß_% 1") for _ in range(rng.randrange(9)))
    rows = [(part(), rng.choice([part().upper(), None, ""]), "abcabc") for _ in range(400)]
    df = spark.createDataFrame(rows + rows[:50], "doc string, name string, town string")
    path = str(tmp_path_factory.mktemp("index"))
    build_index(df, path, COLUMNS, SEARCHED)
    return df, path


def test_terms():
    assert term_grams("abcd") == ["abc", "bcd"] and term_grams("ab%cde_fg") == ["cde"]
    assert term_grams("ab") == [] and term_grams("AbC") == ["abc"]


@pytest.mark.parametrize("term", [
    "aba", "ABa", "b1a", "ab", "", "%", "a_b", "ab%1a", "äba", "ba ab", "aab_", "cab", "  ab1  ", "none of it"])
def test_equals_a_scan(spark, index, term):
    df, path = index
    pattern = f"%{term.strip()}%"
    want = df.filter(df.doc.ilike(pattern) | df.name.ilike(pattern)).distinct()
    got = search_index(spark, path, term, SEARCHED, limit=1000)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_reads_postings_and_confirms(spark, index):
    _, path = index
    plan = search_index(spark, path, "aba", SEARCHED)._jdf.queryExecution().executedPlan().toString()
    assert "postings" in plan and "PushedFilters: [In(gram, [aba" in plan or "EqualTo(gram,aba)" in plan
    assert candidates(spark, path, "ab") is None
