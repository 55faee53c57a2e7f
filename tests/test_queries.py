"""Every registered query against its SQL answer, on the smallest tables."""

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as driver

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return v.replace(tzinfo=None).isoformat() if isinstance(v, datetime.datetime) else repr(v)


def _bag(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, duck, name):
    df = driver.queries()[name](spark, SF)
    rows = df.collect()
    assert rows
    answer = driver.oracle_sql().get(name)
    if answer is None:
        return
    result = duck.execute(answer)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert _bag(rows, df.columns) == _bag(result.fetchall(), columns)


def test_chains_against_the_sequential_pass(spark):
    from checks.queries import _dense

    ks, hs, want = set(), set(), []
    for r in sorted(_dense(spark, SF).collect(), key=lambda r: r["o_orderkey"]):
        if r["dedup_key"] not in ks and r["content_hash"] not in hs:
            want.append(r["o_orderkey"])
            ks.add(r["dedup_key"])
            hs.add(r["content_hash"])
    got = driver.queries()["file_dedup_chains"](spark, SF).collect()
    assert sorted(r["o_orderkey"] for r in got) == want


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["test_analytics", "c"] and df.count() > 0


def test_answers_belong_to_queries():
    assert set(driver.oracle_sql()) <= set(driver.queries())
