"""Document dedup, repeats and upserts against plain models."""

import random

import pytest
from pyspark.sql import functions as F

from labweave.operators import dedup, sinks, skew
from labweave.operators.skew import split_hot_join
from labweave.plans import pipeline
from labweave.session import checkpoint


def greedy(rows, seen_k=(), seen_h=()):
    ks, hs, kept = set(seen_k), set(seen_h), []
    for o, k, h in sorted(rows, key=lambda r: r[0]):
        if k not in ks and h not in hs:
            kept.append(o)
            ks.add(k)
            hs.add(h)
    return kept


@pytest.mark.parametrize("seed, keys, hot", [(1, 4, 2), (2, 40, 3), (3, 200, 10**6), (4, 15, 1)])
def test_greedy_equals_the_sequential_pass(spark, monkeypatch, seed, keys, hot):
    if hot < 10**6:
        monkeypatch.setattr(skew, "fits_broadcast", lambda df: False)
    rng = random.Random(seed)
    rows = [(o, f"k{rng.randrange(keys)}", f"h{rng.randrange(keys)}") for o in range(200)]
    # a third of all rows share one key, some have none
    rows = [(o, "k0" if o % 3 == 0 else k, h) for o, k, h in rows]
    rows = [(o, None if o % 17 == 5 else k, None if o % 19 == 6 else h) for o, k, h in rows]
    docs = spark.createDataFrame(rows, "o int, dedup_key string, content_hash string")
    got = dedup.greedy_kept(docs, order="o", hot_rows=hot).select("o").collect()
    assert sorted(r["o"] for r in got) == greedy(rows)


def test_a_dropped_documents_keys_are_not_remembered(spark):
    rows = [(1, "k1", "h1"), (2, "k2", "h1"), (3, "k2", "h2")]
    docs = spark.createDataFrame(rows, "o int, dedup_key string, content_hash string")
    kept, gone = dedup.dedup_documents(docs, order="o")
    assert sorted(r["o"] for r in kept.collect()) == [1, 3]
    assert [r["o"] for r in gone.collect()] == [2]
    kept, gone = dedup.dedup_documents(docs, order="o", enabled=False)
    assert kept.count() == 3 and gone.count() == 0


def test_documents_kept_earlier_count(spark):
    rows = [(1, "k1", "h1"), (2, "k2", "h2"), (3, "k3", "h9"), (4, "k3", "h3")]
    docs = spark.createDataFrame(rows, "o int, dedup_key string, content_hash string")
    seen = spark.createDataFrame([("k1", "x"), ("y", "h9")], "k string, h string")
    got = dedup.greedy_kept(docs, order="o", seen=seen).select("o").collect()
    assert sorted(r["o"] for r in got) == greedy(rows, ["k1", "y"], ["x", "h9"]) == [2, 4]


@pytest.mark.parametrize("hot", [1, 2_000_000])
def test_null_is_one_value_at_every_size(spark, hot):
    rows = [(1, None, "h1"), (2, None, "h2"), (3, None, None), (4, "k", None), (5, "k", "h5")]
    docs = spark.createDataFrame(rows, "o int, dedup_key string, content_hash string")
    got = dedup.greedy_kept(docs, order="o", hot_rows=hot).select("o").collect()
    assert sorted(r["o"] for r in got) == greedy(rows) == [1, 4]
    seen = spark.createDataFrame([(None, "x")], "k string, h string")
    got = dedup.greedy_kept(docs, order="o", hot_rows=hot, seen=seen).select("o").collect()
    assert sorted(r["o"] for r in got) == greedy(rows, [None]) == [4]


@pytest.mark.parametrize("hot", [1, 10**6])
def test_a_long_chain_takes_few_rounds(spark, monkeypatch, hot):
    """2,000 documents, each sharing its key with the one before and its content with the one after."""
    rounds, plain = [], dedup._chains_kept
    monkeypatch.setattr(dedup, "_chains_kept", lambda *a: rounds.append(1) or plain(*a))
    n = 2000 if hot > 1 else 40
    rows = [(i, f"k{i // 2}", f"h{(i + 1) // 2}") for i in range(n)]
    docs = spark.createDataFrame(rows, "o int, dedup_key string, content_hash string")
    got = dedup.greedy_kept(docs, order="o", hot_rows=hot).select("o").collect()
    assert sorted(r["o"] for r in got) == greedy(rows) and len(rounds) == 1


@pytest.mark.parametrize("seed", range(3))
def test_chains_with_branches_equal_the_sequential_pass(spark, monkeypatch, seed):
    """Chain rounds alone, on graphs of chains, branches, null values and exact copies."""
    monkeypatch.setattr(dedup, "SLOW_ROUND", 0.0)
    rng = random.Random(seed)
    rows = []
    for i in range(150):
        k = f"k{i // 2 if rng.random() < 0.8 else rng.randrange(75)}"
        h = f"h{(i + 1) // 2 if rng.random() < 0.8 else rng.randrange(75)}"
        rows.append((i, None if i % 31 == 7 else k, None if i % 37 == 9 else h))
    docs = spark.createDataFrame(rows, "o int, dedup_key string, content_hash string")
    got = dedup.greedy_kept(docs, order="o").select("o").collect()
    assert sorted(r["o"] for r in got) == greedy(rows)


@pytest.mark.parametrize("hot", [2, 10**6])
@pytest.mark.parametrize("fits", [True, False])
def test_repeats(spark, monkeypatch, hot, fits):
    monkeypatch.setattr(skew, "fits_broadcast", lambda df: fits)
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice(["x", None]), i % 4, None) for i in range(60)]
    df = spark.createDataFrame(
        rows, "o int, name string, result string, page_number int, flag_reason string")
    out = dedup.flag_repeats(df, ["name", "result"], ["o"], hot_rows=hot).collect()
    first = {}
    for o, n, r, p, _ in rows:
        first.setdefault((n, r), (o, p))
    assert len(out) == len(rows)
    for r in out:
        o, p = first[(r["name"], r["result"])]
        assert r["duplicate_within_report"] == (r["o"] > o)
        assert (r["flag_reason"] is None) == (r["o"] == o)
        if r["o"] > o:
            assert f"on page {p} of" in r["flag_reason"]


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
def test_split_join_equals_a_plain_join(spark, how):
    left = spark.range(100).withColumn("k", F.when(F.col("id") % 3 == 0, "hot").otherwise(
        F.concat(F.lit("k"), F.col("id") % 7)))
    right = left.select("k").distinct().filter("k != 'k1'").withColumn("v", F.upper("k"))
    counts = left.groupBy("k").agg(F.count("*").alias("n"))
    right = right.select("k") if how == "left_anti" else right
    got = split_hot_join(left, right, ["k"], counts, how=how, spread=["id"], hot_rows=5)
    want = left.join(right, "k", how).select(*got.columns)
    assert sorted(got.collect()) == sorted(want.collect())


def test_keep_first_and_last(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, None)], "k string, o int, v string")
    assert sorted(dedup.keep_first(df, ["k"], ["o"]).collect()) == [("a", 1, "y"), ("b", 5, None)]
    assert sorted(dedup.keep_last(df, ["k"], ["o"]).collect()) == [("a", 2, "x"), ("b", 5, None)]


def test_upsert_table(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.read_table(spark, path) is None
    one = spark.createDataFrame([(i, "old") for i in range(20)], "id int, v string")
    two = spark.createDataFrame([(3, "new", 1), (50, "new", 2)], "id int, v string, extra int")
    sinks.upsert_parquet(one, path, ["id"])
    for _ in range(2):  # the second time changes nothing
        sinks.upsert_parquet(two, path, ["id"])
    got = {r["id"]: (r["v"], r["extra"]) for r in sinks.read_table(spark, path).collect()}
    want = {i: ("old", None) for i in range(20)} | {3: ("new", 1), 50: ("new", 2)}
    assert got == want
    sinks.upsert_parquet(two, path, ["id"], reset=True)
    assert sinks.read_table(spark, path).count() == 2


@pytest.mark.parametrize("hot_rows", [2, 1_000])
def test_first_and_last_beyond_the_broadcast_bound(spark, monkeypatch, hot_rows):
    """More repeated keys than a broadcast takes: joins by key, hot keys apart, the same rows."""
    rng = random.Random(hot_rows)
    keys = [None, "hot", *map(str, range(30))]
    rows = [(rng.choice(keys) if rng.random() < 0.6 else "hot", rng.choice([None, *range(9)]), i, {"i": i})
            for i in range(400)]
    df = spark.createDataFrame(rows, "k string, o int, i int, m map<string,int>").repartition(5)
    first, last = {}, {}
    for k, o, i, m in rows:
        place = (o is not None, o or 0, i)
        first[k] = min(first.get(k, (place,)), (place,))
        last[k] = max(last.get(k, (place,)), (place,))
    monkeypatch.setattr(dedup, "fits_broadcast", lambda df: False)
    for keep, want in ((dedup.keep_first, first), (dedup.keep_last, last)):
        kept = keep(df, ["k"], ["o", "i"], hot_rows=hot_rows)
        assert kept.columns == df.columns
        assert sorted((r["i"], r["m"]["i"]) for r in kept.collect()) == sorted(
            (v[0][2],) * 2 for v in want.values())


def test_equal_rows_beyond_the_broadcast_bound_leave_one(spark, monkeypatch):
    df = spark.createDataFrame([("a", 1)] * 50 + [("b", 2)], "k string, o int")
    monkeypatch.setattr(dedup, "fits_broadcast", lambda df: False)
    assert sorted(map(tuple, dedup.keep_first(df, ["k"], ["o"]).collect())) == [("a", 1), ("b", 2)]


@pytest.mark.parametrize("fits", [True, False])
@pytest.mark.parametrize("hot_rows", [2, 1_000_000])
def test_first_of_landed_rows_moves_no_row(spark, monkeypatch, fits, hot_rows):
    """Beyond one bitmap's rows in a file, null keys, many copies of one key: the same rows, in their files."""
    rows = spark.range(0, 70_000, 1, 2).select(
        F.when(F.col("id") % 5 == 0, F.lit("hot")).when(F.col("id") % 7 == 0, None).otherwise(
            (F.col("id") % 40_000).cast("string")).alias("k"),
        (-F.col("id")).alias("o"), F.create_map(F.lit("i"), "id").alias("m"))
    landed = checkpoint(rows.coalesce(1).unionByName(rows.limit(3)))
    want = {}
    for r in landed.collect():
        want[r["k"]] = min(want.get(r["k"], 0), r["o"])
    monkeypatch.setattr(dedup, "fits_broadcast", lambda df: fits)
    kept = dedup.keep_first_landed(landed, ["k"], ["o"], hot_rows=hot_rows)
    assert kept.columns == landed.columns
    got = kept.collect()
    assert {r["k"]: r["o"] for r in got} == want and len(got) == len(want)
    assert all(r["m"]["i"] == -r["o"] for r in got)
    if fits:
        assert "Exchange hashpartitioning" not in kept._jdf.queryExecution().executedPlan().toString()


def test_stored_rows_are_counted_on_keys_and_places(spark, monkeypatch):
    """Beyond the broadcast bound whole rows were landed again, and shuffled, even to be counted."""
    landed = checkpoint(spark.createDataFrame(
        [("a", 2, "x"), ("a", 1, "y"), ("b", 5, None)], "id string, o int, wide string"))
    monkeypatch.setattr(pipeline.mapping, "ORDER", ["o"])
    names, real = [], dedup.checkpoint
    monkeypatch.setattr(dedup, "checkpoint", lambda df, name: names.append((name, df.columns)) or real(df, name))
    monkeypatch.setattr(dedup, "fits_broadcast", lambda df: df.columns[0] == "_in")
    assert pipeline.load_rows(landed).count() == 2
    assert names and not any("wide" in cols for _, cols in names)


@pytest.mark.parametrize("hot", [2, 10**6])
def test_repeats_of_landed_rows_move_no_row(spark, monkeypatch, hot):
    """Beyond the broadcast bound all rows, wide as they are, had been shuffled and sorted to meet the groups."""
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "b", None]) if i % 9 == 0 else f"n{i}", rng.choice(["x", None]), rng.choice(
        [None, "1", "2"]), rng.choice([None, "", "odd"]), i * 0.5) for i in range(400)]
    landed = checkpoint(spark.createDataFrame(
        rows, "o int, name string, result string, page_number string, flag_reason string, wide double").repartition(3))
    want = dedup.flag_repeats(landed, ["name", "result"], ["o"])
    monkeypatch.setattr(skew, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(dedup, "fits_broadcast", lambda df: df.columns[0] == "_in")
    got = dedup.flag_repeats(dedup.placed(landed), ["name", "result"], ["o"], hot_rows=hot)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:  # rows that are not flagged, the first half of the union, meet the bitmaps alone
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "Exchange hashpartitioning" not in plan.split("_at#")[0].split("ShuffledHashJoin")[0]


def test_kept_documents_of_landed_ones_move_no_body(spark, monkeypatch):
    """A list of copies beyond the broadcast bound had shuffled every body, once per use."""
    docs = checkpoint(spark.range(100).select(
        F.when(F.col("id") != 7, F.array(F.lpad(F.col("id").cast("string"), 3, "0"))).alias("path_parts"),
        F.parse_json(F.lit("{}")).alias("body")).repartition(3))
    monkeypatch.setattr(dedup, "fits_broadcast", lambda df: df.columns[0] == "_in")
    kept, dropped = dedup.split_by_kept(
        dedup.placed(docs), docs.filter("path_parts[0] < '060'"), "path_parts")
    assert kept.columns == dropped.columns == docs.columns
    assert (kept.count(), dropped.count()) == (60, 40)  # with the one that has no path
    for df in (kept, dropped):
        assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()


def test_documents_are_left_as_they_are_without_dedup(spark):
    docs = checkpoint(spark.range(3))
    kept, dropped = dedup.dedup_documents(dedup.placed(docs), enabled=False)
    assert kept.columns == docs.columns and kept.count() == 3 and dropped.count() == 0
