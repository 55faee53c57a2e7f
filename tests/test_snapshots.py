"""Delta tables against a plain dictionary, and what a search in them reads."""

import random

import pytest
from pyspark.sql import functions as F

from labweave.operators import snapshots
from labweave.sources import config


def put(spark, root, rows, run, schema="id int, part string, v int", **options):
    options = {"keys": ["id"], **options}
    delta = snapshots.write_delta(spark.createDataFrame(rows, schema), root, "t", run=run, **options)
    return snapshots.publish(spark, root, [delta], run=run)


def rows_of(spark, root, **options):
    found = snapshots.read(spark, root, "t", **options)
    return None if found is None else sorted(map(tuple, found.collect()), key=repr)


def scanned(df):
    """Rows that the plan's file scans gave out, by a run of it."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getName() else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_upserts_folds_and_reads(spark, tmp_path, seed):
    rng, root, model = random.Random(seed), str(tmp_path), {}
    assert rows_of(spark, root) is None
    for step in range(7):
        batch = {rng.choice([*range(30), None]): (rng.choice(["a", "b", None]), step)
                 for _ in range(rng.choice([1, 3, 20]))}
        put(spark, root, [(k, *v) for k, v in batch.items()], f"r{step}", by=["part"], lookup=["id"])
        model.update(batch)
        if rng.random() < 0.6:
            snapshots.fold(spark, root, "t", few=1)
        assert rows_of(spark, root) == sorted(((k, *v) for k, v in model.items()), key=repr)
    snapshots.fold(spark, root, "t", ratio=0)
    assert len(snapshots.snapshot(spark, root).tables["t"]) == 1
    assert rows_of(spark, root) == sorted(((k, *v) for k, v in model.items()), key=repr)


def test_a_small_batch_writes_only_its_own_files(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, [(i, "a", 0) for i in range(500)], "big")
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    put(spark, root, [(3, "a", 1)], "small")
    assert snapshots.fold(spark, root, "t", few=1) == 0
    after = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    assert before.items() <= after.items() and 1 <= len(after) - len(before) <= 2
    assert dict((r[0], r[2]) for r in rows_of(spark, root))[3] == 1


def test_runs_numbers_resets_and_old_snapshots(spark, tmp_path):
    root = str(tmp_path)
    put(spark, root, [(1, "a", 1), (2, "a", 1)], "x")
    put(spark, root, [(2, "a", 2)], "y")
    put(spark, root, [(1, "a", 3)], "x")  # x again, in place of its first rows
    assert rows_of(spark, root) == [(1, "a", 3), (2, "a", 2)]
    assert rows_of(spark, root, number=1) == [(1, "a", 1), (2, "a", 1)]
    delta = lambda v: [snapshots.write_delta(
        spark.createDataFrame([(9, "a", v)], "id int, part string, v int"), root, "t", run="s", keys=["id"])]
    assert snapshots.publish(spark, root, delta(1), run="s", number=0)
    assert not snapshots.publish(spark, root, delta(2), run="s", number=0)
    assert snapshots.publish(spark, root, delta(3), run="s", number=1)
    assert (9, "a", 3) in rows_of(spark, root)
    snapshots.publish(spark, root, delta(7), run="z", reset=True)
    assert rows_of(spark, root) == [(9, "a", 7)]


def test_columns_may_come_later(spark, tmp_path):
    put(spark, str(tmp_path), [(1, "a", 1)], "x")
    put(spark, str(tmp_path), [(2, "a", 1, "new")], "y", "id int, part string, v int, more string")
    assert rows_of(spark, str(tmp_path)) == [(1, "a", 1, None), (2, "a", 1, "new")]


def test_two_writers_and_vacuum(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    put(spark, root, [(1, "a", 1)], "x")
    stale = snapshots.snapshot(spark, root)
    put(spark, root, [(2, "a", 1)], "y")
    with monkeypatch.context() as m:
        m.setattr(snapshots, "snapshot", lambda *a, **k: stale)
        with pytest.raises(RuntimeError):
            put(spark, root, [(3, "a", 1)], "late")
    assert len(rows_of(spark, root)) == 2
    snapshots.fold(spark, root, "t", ratio=0)
    assert snapshots.vacuum(spark, root, older=lambda ms: False) == 0
    assert snapshots.vacuum(spark, root, keep=1) == 3  # two folded ones and the loser's
    assert len(rows_of(spark, root)) == 2


def test_empty_text_is_no_partition(spark, tmp_path):
    with pytest.raises(Exception, match="empty text"):
        put(spark, str(tmp_path), [(1, "", 1)], "x", by=["part"])


def test_a_lookup_skips_partitions_and_row_groups(spark, tmp_path):
    """Ids are spread so that ranges can't help: the Bloom filters tell which row group has one."""
    root = str(tmp_path)
    rows = spark.range(40_000).select(
        F.col("id").cast("int").alias("id"), F.concat(F.lit("p"), F.col("id") % 2).alias("part"),
        F.sha2(F.col("id").cast("string"), 256).alias("doc"))
    spark.conf.set("parquet.block.size", str(64 * 1024))
    _, delta = snapshots.write_delta(rows, root, "t", run="x", keys=["id"], by=["part"], lookup=["doc"])
    snapshots.publish(spark, root, [("t", delta)], run="x")
    table = snapshots.read(spark, root, "t")
    assert scanned(table.filter("part = 'p1'")) == 20_000
    wanted = rows.filter("id = 777").first()["doc"]
    hit = table.filter(F.col("doc") == wanted)
    assert 1 <= scanned(hit) < 20_000 and hit.count() == 1
    assert scanned(table.filter(F.col("doc") == "absent")) == 0


def test_a_retraction_takes_older_rows_only(spark, tmp_path):
    """Against a dict of rows: keyed and other tables, folds in between, nulls like any value."""
    root = str(tmp_path / "r")

    def write(run, rows, gone=None):
        deltas = []
        for table, keys in (("keyed", ["k"]), ("plain", [])):
            if gone is not None:
                deltas.append(snapshots.write_retraction(
                    spark.createDataFrame(gone, "f string"), root, table, ["f"], run=run))
            deltas.append((table, snapshots.write_delta(
                spark.createDataFrame(rows, "k int, f string"), root, table, run=run, keys=keys)[1]))
        snapshots.publish(spark, root, deltas, run=run)

    def read(table):
        return sorted(map(tuple, snapshots.read(spark, root, table).collect()), key=str)

    write("a", [(1, "x"), (2, "y"), (3, None)])
    write("b", [(2, "x"), (4, "z")])
    assert read("keyed") == [(1, "x"), (2, "x"), (3, None), (4, "z")]
    write("c", [(5, "x")], gone=[("x",), (None,), ("x",)])
    # 2 moved to x, which went: its older row under y stays away
    assert read("keyed") == [(4, "z"), (5, "x")]
    assert read("plain") == [(2, "y"), (4, "z"), (5, "x")]
    write("d", [(6, "z")])
    for table in ("keyed", "plain"):
        want = read(table)
        assert snapshots.fold(spark, root, table, few=1) <= 2  # not across the retraction
        assert read(table) == want
        snapshots.fold(spark, root, table, ratio=0)
        assert read(table) == want and len(snapshots.snapshot(spark, root).tables[table]) == 1
    write("e", [], gone=[("z",)])
    assert read("keyed") == [(5, "x")] and read("plain") == [(2, "y"), (5, "x")]


def test_many_newer_keys_meet_the_older_rows_in_a_shuffle(spark, tmp_path, monkeypatch):
    """Ids are nearly all of a file's bytes, but Spark's estimate takes a column's even share of them."""
    monkeypatch.setattr(config, "BROADCAST_ROWS", 50)
    root, schema = str(tmp_path), "id string, a string, b string, c string, d string"
    for run, size in (("old", 200), ("new", 100)):
        rows = [(f"{i:064d}", "x", "x", "x", run) for i in range(size)]
        put(spark, root, rows, run, schema=schema)
    found = snapshots.read(spark, root, "t")
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.groupBy("d").count().orderBy("d").collect() == [("new", 100), ("old", 100)]


def test_many_retracted_values_meet_the_older_rows_in_a_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(config, "BROADCAST_ROWS", 50)
    root = str(tmp_path)
    put(spark, root, [(i, "a", 0) for i in range(200)], "old")
    gone = spark.range(100).selectExpr("cast(id as int) as id")
    snapshots.publish(spark, root, [snapshots.write_retraction(gone, root, "t", ["id"], run="r")], run="r")
    found = snapshots.read(spark, root, "t")
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 100
