"""Scalar transforms: tables of input and expected output."""

import datetime
import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from labweave import functions as fn
from labweave.functions.json_paths import is_object
from labweave.sources.files import _valid_utf8


def evaluate(spark, inputs, build):
    """``build(column)`` over the inputs, in their order."""
    rows = [(i, x) for i, x in enumerate(inputs)]
    df = spark.createDataFrame(rows, "i int, x string").select("i", build(F.col("x")).alias("y"))
    return [r["y"] for r in df.orderBy("i").collect()]


NUMBERS = [
    # text, value, flag, residual unit, is numeric, contradictory
    ("64.2", 64.2, None, None, True, False),
    ("315 drops/jar", 315.0, None, "drops/jar", True, False),
    ("H 0.7", 0.7, "H", None, True, False),
    ("l 3", 3.0, "L", None, True, False),
    ("High 3", 3.0, None, "High", True, False),
    ("NEGATIVE", None, None, None, False, False),
    ("Pale  Yellow", None, None, None, False, False),
    ("p a l e", None, None, None, False, False),
    ("n / a", None, None, None, False, False),
    ("3.5 - 9", None, None, None, False, True),
    (" -1.5 - 2 ", None, None, None, False, True),
    ("1,200", 1.0, None, ",200", True, False),
    ("1:80", 1.0, None, ":80", True, False),
    ("120/80 mmHg", 120.0, None, "/80 mmHg", True, False),
    ("a -5", -5.0, None, "a", True, False),
    ("12.", 12.0, None, None, True, False),
    ("  7 ", 7.0, None, None, True, False),
    ("OTE", None, None, None, False, False),
    ("H", None, "H", None, False, False),
    ("", None, None, None, False, False),
    (None, None, None, None, False, False),
]


def test_numbers(spark):
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(NUMBERS)], "i int, x string")
    got = [tuple(r["n"])[:5] for r in fn.with_number(df, "x", "n").orderBy("i").collect()]
    assert got == [tuple(r[1:]) for r in NUMBERS]


@pytest.mark.parametrize("build, cases", [
    (fn.parse_range, {"1-2": (1.0, 2.0), " 0.5 - 10 ": (0.5, 10.0), "-5--1": (-5.0, -1.0),
                      "< 5": (None, None), "1-2-3": (None, None), "": (None, None),
                      None: (None, None)}),
    (fn.parse_age, {"58": ("58", 58.0, None, None), "12Y4M31D": ("12Y4M31D", 12.0, 4.0, 31.0),
                    "66Y": ("66Y", 66.0, 0.0, 0.0), "45 years": ("45 years", 45.0, 0.0, 0.0),
                    "3m": ("3m", 0.0, 3.0, 0.0), " 7.5 ": ("7.5", 7.5, None, None),
                    "[AGE REDACTED]": ("[AGE REDACTED]", None, None, None),
                    "adult": ("adult", None, None, None), "": (None,) * 4, None: (None,) * 4}),
    (fn.parse_gender, {"M": "Male", " female ": "Female", "woman": "Female", "trans": "Other",
                       "[GENDER REDACTED]": None, "": None, None: None, " x ": " x "}),
    (fn.normalise_name, {"CLOUDINESS": "cloudiness", "Mg+": "mg+", "  N/P  Quotient ": "n/p quotient",
                         "Cloudiness (by eye/second glass)": "cloudiness",
                         "OXYGEN, DISSOLVED": "oxygen dissolved", "(x)": ""}),
    (fn.normalise_medicine, {"Calmex 15mg": "calmex", "CAP. ORP 30": "orp", "CAP. ORP X": "orp x",
                             "0.5% Brenta": "brenta", "Inj. Zal": "zal",
                             "TAB QUORIL 70 MG": "quoril", "Miller's  Drops": "miller s drops"}),
    (lambda c: fn.split_composite(c), {
        "Sand - 51.5, Silt - 22.5, Clay - 26":
            [("Sand", "51.5"), ("Silt", "22.5"), ("Clay", "26")],
        "64.2": None, "a, b": None, "a - 1, b": None, "": None, None: None}),
    (lambda c: fn.number_text(c.try_cast("double")), {
        "12": "12.0", "0.05": "0.05", "12345678": "12345678.0", "1e9": "1000000000.0",
        "0.0005": "0.0005", "0": "0.0", None: None}),
])
def test_scalars(spark, build, cases):
    got = evaluate(spark, list(cases), build)
    plain = [
        [tuple(x) for x in g] if isinstance(g, list) else tuple(g) if isinstance(g, tuple) else g
        for g in got
    ]
    assert plain == list(cases.values())


DATES = [
    # text, declared format, expected
    ("15/06/2026", "%d/%m/%Y", "2026-06-15"), ("2026-06-15", "%d/%m/%Y", "2026-06-15"),
    ("05/06/2026", "%d/%m/%Y", "2026-06-05"), ("05/06/2026", "%m/%d/%Y", "2026-05-06"),
    ("05/06/2026", None, "2026-06-05"), ("06/16/2026", "%d/%m/%Y", "2026-06-16"),
    ("04-10-2025", "%d/%m/%Y", "2025-10-04"), ("07-Oct-2025", "%d/%m/%Y", "2025-10-07"),
    ("7/oct/2025", None, "2025-10-07"), ("07-October-2025", None, "2025-10-07"),
    ("1.2.2025", None, "2025-02-01"), ("31/02/2026", None, None), ("05/06/26", None, None),
    ("BOX 77", "%d/%m/%Y", None), ("DD/MM/YYYY", None, None), ("n/a", None, None),
    ("", None, None), (None, None, None), ("20260615", "%Y%m%d", "2026-06-15"),
]


def test_dates(spark):
    df = spark.createDataFrame(
        [(i, t, f) for i, (t, f, _) in enumerate(DATES)], "i int, t string, f string")
    got = df.select("i", fn.parse_date("t", fn.spark_date_pattern("f")).alias("d")).orderBy("i")
    want = [d and datetime.date.fromisoformat(d) for _, _, d in DATES]
    assert [r["d"] for r in got.collect()] == want


CLASSES = [
    # name, type, text, unit, expected unit, bounds, status, excluded
    ("Tu", "numeric", "14.5", "g", "g", (11, 19, 2, 40), "Within Range", False),
    ("Tu", "numeric", "11", "g", "g", (11, 19, 2, 40), "Within Range", False),
    ("Tu", "numeric", "19", "g", "g", (11, 19, 2, 40), "Within Range", False),
    ("Tu", "numeric", "10.7", "g", "g", (11, 19, 2, 40), "Below Range", False),
    ("Tu", "numeric", "21", "g", "g", (11, 19, 2, 40), "Above Range", False),
    ("Tu", "numeric", "2", "g", "g", (11, 19, 2, 40), "Below Range", False),
    ("Tu", "numeric", "950", "g", "g", (11, 19, 2, 40), "Outlier", False),
    ("Tu", "numeric", "14", "ml", "g", (11, 19, 2, 40), "Invalid", True),
    ("Tu", "numeric", "3.5 - 9", "ml", "g", (11, 19, 2, 40), "Invalid", True),
    ("Tu", "numeric", "3.5 - 9", None, "g", (11, 19, 2, 40), "Invalid", False),
    ("Tu", "numeric", "AWAITED", "g", "g", (11, 19, 2, 40), "Invalid", False),
    ("Tu", "numeric", " ", "g", "g", (11, 19, 2, 40), "Unclassified", False),
    ("Tu", "numeric", None, "g", "g", (11, 19, 2, 40), "Unclassified", False),
    ("New", "numeric", "5", None, None, (None,) * 4, "Unclassified", False),
    ("Col", "text", "Clear", "ml", "g", (None,) * 4, "Not Applicable", False),
    ("BP", "composite", "120/80", None, "mmHg", (None,) * 4, "Unclassified", False),
]


def test_classification(spark):
    rows = [(i, *c[:5], *[None if b is None else float(b) for b in c[5]])
            for i, c in enumerate(CLASSES)]
    df = spark.createDataFrame(
        rows, "i int, name string, vt string, x string, u string, want string, lo double, "
              "hi double, olo double, ohi double")
    out = fn.with_number(df, "x", "n").select("i", fn.classify(
        name="name", value_type="vt", number="n", unit="u", expected_unit="want", low="lo",
        high="hi", outlier_low="olo", outlier_high="ohi").alias("c")).orderBy("i").collect()
    assert [(r["c"]["status"], r["c"]["exclude"]) for r in out] == [c[6:] for c in CLASSES]


def test_paths(spark):
    body = {"a": {"x y": {"q": 5}}, "n": None, "l": [1, None, "t"], "o": {"k": 1}, "e": []}
    df = spark.createDataFrame([(json.dumps(body),)], "j string").select(
        F.parse_json("j").alias("v"))
    at = lambda p: fn.path_value("v", fn.json_path(F.lit(p)))
    row = df.select(
        fn.path_text("v", fn.json_path(F.lit("a.x y.q"))).alias("deep"),
        at("a.zz").isNull().alias("missing"), at("l.a").isNull().alias("through_list"),
        at("n").isNotNull().alias("null_present"), fn.path_text("v", F.lit("$['n']")).alias("n"),
        fn.json_path(F.lit("")).isNull().alias("blank"),
        fn.shape_ok("v", F.array(F.lit("n"), F.lit("a"))).alias("ok"),
        fn.shape_ok("v", F.array(F.lit("zz"))).alias("bad"),
        fn.flatten_value(at("l")).alias("list"), fn.flatten_value(at("o")).alias("object"),
        fn.flatten_value(at("e")).alias("empty"), fn.flatten_value(at("a.x y.q")).alias("scalar"),
        is_object(at("o")).alias("is_o"), is_object(at("l")).alias("is_l"),
        is_object(at("n")).alias("is_n"),
    ).first().asDict()
    assert row == {
        "deep": "5", "missing": True, "through_list": True, "null_present": True, "n": None,
        "blank": True, "ok": True, "bad": False, "list": "1; None; t", "object": '{"k":1}',
        "empty": None, "scalar": "5", "is_o": True, "is_l": False, "is_n": False,
    }


def test_pair_lists(spark):
    body = {"m": [{"key": "a", "value": "1"}, {"key": "b"}, {"value": "x"}, {"key": "a", "value": 2}]}
    df = spark.createDataFrame([(json.dumps(body),), ('{"m": 5}',), ("{}",)], "j string")
    got = df.select(fn.pairs_to_map(F.parse_json("j"), F.lit("$['m']")).alias("m")).collect()
    assert [r["m"] for r in got] == [{"a": "2", "b": None}, {}, {}]


def _without_pages(v):
    if isinstance(v, dict):
        return {k: _without_pages(x) for k, x in v.items() if k != "page_no"}
    return [_without_pages(x) for x in v] if isinstance(v, list) else v


def _random_json(rng, depth):
    if depth == 0 or rng.random() < 0.4:
        return rng.choice([1, 2, None, True, "a", 'q"page_no":1,', '{"page_no":1', "é", 1.5])
    if rng.random() < 0.3:
        return [_random_json(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    out = {k: _random_json(rng, depth - 1) for k in rng.sample("abxyz", rng.randint(0, 3))}
    if rng.random() < 0.6:
        out["page_no"] = rng.choice([0, 12, "p, \"1\" }", None, "x]y", 3.5])
    return out


def test_payload_hash_ignores_pages_only(spark):
    """Equal hashes exactly for documents equal without their page numbers."""
    rng = random.Random(5)
    docs = [{"p": _random_json(rng, 4), "id": i % 2} for i in range(300)]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, j string")
    df = df.select("i", fn.payload_hash(F.parse_json("j"), F.lit("$['p']")).alias("h"))
    got = {r["i"]: r["h"] for r in df.collect()}
    by_hash, by_model = {}, {}
    for i, d in enumerate(docs):
        # A missing or null payload falls back to the whole body.
        payload = d if d["p"] is None else d["p"]
        model = json.dumps(_without_pages(payload), sort_keys=True)
        by_hash.setdefault(got[i], set()).add(i)
        by_model.setdefault(model, set()).add(i)
    assert sorted(map(sorted, by_hash.values())) == sorted(map(sorted, by_model.values()))


def test_row_id(spark):
    df = spark.createDataFrame([("d", None, 1.5)], "a string, b string, c double")
    got = df.select(fn.row_id(["a", "b", "c"])).first()[0]
    assert got == hashlib.sha256(b"d||1.5").hexdigest()


def test_document_key_skips_absent_parts(spark):
    bodies = ['{"d":"1","c":"2"}', '{"d":"1","c":""}', '{"d":null}', '{"d":1}']
    got = evaluate(spark, bodies, lambda c: fn.document_key(
        F.parse_json(c), F.array(F.lit("$['d']"), F.lit("$['c']")), F.lit("other")))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == [sha("1|2"), sha("1"), "other", sha("1")]


def test_utf8_is_judged_as_by_a_check_of_all_bytes(spark):
    random.seed(5)
    odd = [b"", b"abc", "ä€😀".encode(), "\ufffd".encode(), b"\xc0\x80", b"\xed\xa0\x80", b"\xf4\x90\x80\x80", b"\xe2\x82",
           b"a\xffb", b"\xef\xbf\xbe", None]
    odd += [bytes(random.choices(b"a\x7f\x80\x9f\xa0\xbf\xc2\xe0\xed\xef\xf0\xf4\xf5\xff", k=random.randint(1, 5)))
            for _ in range(3000)]
    odd += [b"ok " + "é".encode() * 3 + b for b in odd if b]
    df = spark.createDataFrame([(x,) for x in odd], "x binary").select(F.col("x").cast("string").alias("t"))
    rows = df.select(_valid_utf8(F.col("t")).alias("got"), F.is_valid_utf8("t").alias("want")).collect()
    assert all(r["got"] == r["want"] for r in rows)
    assert {r["want"] for r in rows} == {True, False, None}
