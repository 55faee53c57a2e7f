"""Sketches of days against exact counts, and merged against built at once."""

import random

from pyspark.sql import functions as F

from labweave.operators.sketches import (
    DISTINCT, DISTINCT_ERROR, RANK_ERROR, day_sketches, merge_sketches, read_sketches)

SCHEMA = ("record_type string, clinic_id string, date_str string, document_id string, "
          "test_name_original string, normalization_method string, result_value double")


def made(n, seed=5):
    rng = random.Random(seed)
    return [("lab_test", rng.choice(["p", "p", "p", "q", None]), f"2031-02-{rng.randint(1, 9):02d}",
             f"d{rng.randrange(n // 3)}", f"t{rng.randrange(n // 5)}",
             rng.choice(["exact", "exact", "unresolved"]), rng.choice([None, rng.gauss(50, 9)])) for _ in range(n)]


def test_merged_days(spark):
    rows = made(30_000)
    df = spark.createDataFrame(rows + [("medication", "p", "2031-02-01", "m", None, None, None)], SCHEMA)
    days = day_sketches(df)
    got = {r.clinic_id: r for r in read_sketches(merge_sketches(days, "clinic_id")).collect()}
    assert set(got) == {"p", "q", None}
    for clinic, r in got.items():
        own = [x for x in rows if x[1] == clinic]
        unresolved = [x for x in own if x[5] == "unresolved"]
        assert (r.rows, r.unresolved_rows) == (len(own), len(unresolved))
        for name, exact in (("documents", {x[3] for x in own}), ("test_names", {x[4] for x in own}),
                            ("unresolved_names", {x[4] for x in unresolved})):
            assert abs(r[name] - len(exact)) <= DISTINCT_ERROR * len(exact)
        values = [x[6] for x in own if x[6] is not None]
        assert r.results == len(values)
        for name, q in (("p05", 0.05), ("median", 0.5), ("p95", 0.95)):
            assert abs(sum(v <= r[name] for v in values) / len(values) - q) <= RANK_ERROR


def test_days_merge_into_the_sketch_of_all(spark):
    """Any way of cutting the rows gives the same registers."""
    df = spark.createDataFrame(made(5_000), SCHEMA)
    cut = merge_sketches(day_sketches(df))
    whole = merge_sketches(day_sketches(df.withColumn("date_str", F.lit("x")).withColumn("clinic_id", F.lit("x"))))
    for c in DISTINCT:
        pair = cut.select(F.col(c).alias("a")).crossJoin(whole.select(F.col(c).alias("b")))  # one row each
        est = lambda x, y: F.hll_sketch_estimate(F.hll_union(x, y))
        assert len({*pair.select(est("a", "a"), est("a", "b"), est("b", "b")).first()}) == 1


def test_nothing_to_sketch(spark):
    none = spark.createDataFrame([("lab_test", None, None, None, None, None, None),
                                  ("lab_test", "p", "2031-02-01", "d", "t", "exact", float("nan"))], SCHEMA)
    got = {r.clinic_id: r for r in read_sketches(merge_sketches(day_sketches(none), "clinic_id")).collect()}
    assert (got[None].rows, got[None].documents, got[None].results, got[None].median) == (1, 0, 0, None)
    assert (got["p"].documents, got["p"].results, got["p"].p95) == (1, 0, None)
    assert read_sketches(merge_sketches(day_sketches(none.limit(0)), "clinic_id")).count() == 0
