"""Zones of markup, line alignment and pairing by url."""

import itertools
import os
import random

import pytest

from labweave.llm.page_text import (
    MAIN, MARKED, OTHER, REACH, common_lines, extract_text, guests_of, main_text, pack, page_lines,
    shared_lines, unpack)


def test_zones():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
    <header><p>Site</p></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
    <script>var t="</p><article>";</script><!-- <p>no</p> -->
    <div class="cookie-notice">Accept?</div>
    <article><header><h1>Head &amp; line</h1></header><p>One\n  two<br>three<p><b>Four
    <div class="ad">Buy</div><p>Five &lt;b&gt; &#233;</p><form><p>Mail</p></form>
    <section id="comments"><p>First!</p></section><footer>By</footer></article>
    <p>after</p><footer>&copy; x</footer>"""
    lines = page_lines(page)
    assert [t for t, z in lines if z == MAIN] == ["Head & line", "One two three", "Four", "Five <b> é"]
    assert [t for t, z in lines if z == OTHER] == ["after"]
    assert [t for t, z in lines if z == MARKED] == [
        "Site", "Home", "Accept?", "Buy", "Mail", "First!", "By", "© x"]
    assert main_text(lines, []) == ("Head & line\n\nOne two three\n\nFour\n\nFive <b> é", 0)
    assert unpack(pack(lines)) == lines and unpack(pack([])) == []


@pytest.mark.parametrize("page", ["", "<", "<p", "a<b", "<p>x", "</div></p>", "<script>", "&", "<!--", "<p a='>'>q"])
def test_broken_pages(page):
    assert all(t == " ".join(t.split()) and t for t, _ in page_lines(page))


def test_longest_common_lines():
    rng = random.Random(2)
    for _ in range(200):
        a = rng.choices("abcd", k=rng.randint(0, 7))
        b = rng.choices("abcd", k=rng.randint(0, 7))
        got = common_lines(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(i < k and j < m for (i, j), (k, m) in zip(got, got[1:]))
        best = max((len(c) for n in range(len(a) + 1) for c in itertools.combinations(range(len(a)), n)
                    if (lambda it: all(a[i] in it for i in c))(iter(b))), default=0)
        assert len(got) == best


def test_sites_without_markup(spark):
    """Lines that neighbours share go, lines of copies stay."""
    page = lambda *own: "<div>Menu one</div>" + "".join(f"<p>{x}</p>" for x in own) + "<div>Imprint</div>"
    rows = [(k, f"https://a.example/news/{k}", page(f"story {k}", f"more {k}", f"end {k}"), "n") for k in range(40)]
    rows += [(100, "http://b.example/x", page("alone"), "n"), (101, None, page("no url"), "n"),
             (102, "http://c.example/y", None, "n"), (103, "http://c.example/z", "", "n"),
             (104, "http://d.example/p?a=1", page("copy", "two"), "n"),
             (105, "http://d.example/p?a=2", page("copy", "two"), "n"),
             (None, "http://e.example/", "<p>x</p>", None), (106, "http://f.example/", "<p>y</p>" * 3000, "n"),
             (106, "http://f.example/", "<p>y</p>" * 3000, "n")]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = extract_text(df).collect()
    got = {r.page_id: r.text for r in out}
    assert len(out) == len(rows)
    assert all(got[k] == f"story {k}\n\nmore {k}\n\nend {k}" for k in range(40))
    assert got[100] == "Menu one\n\nalone\n\nImprint" and got[102] == got[103] == ""
    assert got[104] == got[105] == "Menu one\n\ncopy\n\ntwo\n\nImprint"
    assert got[106].count("y") == 3000
    assert all(r.n_chars == len(r.text) for r in out)
    assert extract_text(df.limit(0)).count() == 0


MENU = ["Start", "Stock list", "Prices", "Branches", "Jobs here", "Press", "Imprint and data", "Terms"]


def site(host, marked, own, tail=""):
    """Pages with the same eight lines around their own."""
    inner = lambda lines: "".join(f"<div>{x}</div>" for x in [*MENU[:6], *lines, *MENU[6:]])
    return [(f"https://{host}/{path}{tail}", f"<article>{inner(x)}</article>" if marked else inner(x))
            for path, x in own]


def texts(spark, pages):
    rows = [(k, u, h) for k, (u, h) in enumerate(pages)]
    random.Random(4).shuffle(rows)
    out = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string"))
    return [(r.text.split("\n\n"), r.n_shared) for r in sorted(out.collect(), key=lambda r: r.page_id)]


@pytest.mark.parametrize("marked", [False, True])
def test_eight_menu_lines_beside_two_own(spark, marked):
    own = [(f"news/{k}", [f"What happened in place {k}", f"Nobody knew of number {k} before"]) for k in range(9)]
    assert texts(spark, site("m.example", marked, own)) == [(x, 8) for _, x in own]


def test_copies_do_not_hide_siblings(spark):
    """Exact copies under other addresses, and a near copy, beside two siblings."""
    rng = random.Random(6)
    said = lambda: " ".join(rng.choices(["sun", "rain", "wind", "fog", "hail", "frost", "dew"], k=40))
    mine = [said(), said()]
    near = [mine[0], mine[1].replace("fog", "mist", 2)]
    others = [[said(), said()] for _ in range(2)]
    pages = site("c.example", False, [("a/1", mine)])
    pages += [(f"{pages[0][0]}?ref={k}", pages[0][1]) for k in range(30)]
    pages += site("c.example", False, [("a/1b", near), ("a/2", others[0]), ("b/3", others[1])])
    assert [t for t, _ in texts(spark, pages)] == [mine] * 31 + [near, *others]


def test_shared_passage_of_articles_stays(spark):
    """A passage that all pages quote inside their article is theirs; too few lines for a menu."""
    rows = [(f"https://q.example/{k}", f"<nav>Go</nav><article><p>As we always say.</p><p>Item {k} is new.</p></article>")
            for k in range(7)]
    assert texts(spark, rows) == [(["As we always say.", f"Item {k} is new."], 0) for k in range(7)]


def test_articles_are_differenced_too(spark):
    """The partner's step runs on pages that mark their article, with one sibling or more; a copy is no
    partner, and a lone page has none."""
    page = lambda k: (f"<nav>Go there</nav><article><p>As we always say.</p><p>Item {k} came in new today, "  # noqa: E731
                      f"number {k * 7} of {k} boxes.</p></article><footer>Imprint</footer>")
    rows = [(k, f"https://q.example/{k}", page(k)) for k in range(2)] + [
        (9, "https://q.example/0?copy", page(0)), (10, "https://r.example/", page(5))]
    out = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: (r.n_shared, r.n_partner) for r in out} == {0: (0, 3), 1: (0, 3), 9: (0, 3), 10: (0, 0)}
    assert all(r.text.startswith("As we always say.\n\nItem ") for r in out)


def plain(rows):
    """Every page against its neighbouring runs, over the sorted list at once."""
    def place(url):
        rest = url.split("://", 1)[1]
        host, _, path = rest.partition("/")
        return host.lower(), ("/" + path).split("?")[0].split("#")[0]

    at = sorted((*place(u), k, h) for k, u, h in rows)
    runs = []
    for host, path, k, h in at:
        lines = page_lines(h)
        if not runs or (runs[-1][0], runs[-1][1]) != (host, lines):
            runs.append((host, lines, []))
        runs[-1][2].append((path, k))
    out = {}
    for n, (host, lines, pages) in enumerate(runs):
        for path, k in pages:
            near = []
            for d in range(1, REACH + 1):
                for m, end in ((n - d, -1), (n + d, 0)):
                    if 0 <= m < len(runs) and runs[m][0] == host and runs[m][1] != lines:
                        score = len(os.path.commonprefix([path, runs[m][2][end][0]]))
                        near.append((-score, len(near), runs[m][1]))
            found = [shared_lines([t for t, _ in lines], [t for t, _ in x[2]])
                     for x in sorted(near, key=lambda x: x[:2])]
            out[k] = main_text(lines, found)
    return out


@pytest.mark.parametrize("seed, parts", [(0, "1"), (1, "8"), (2, "40")])
def test_random_sites(spark, seed, parts):
    """Partners, runs over the cuts and deletions, on marked and unmarked sites."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["oak", "elm", "ash", "fir", "yew"])
    rows = []
    for host in ("x.example", "y.example", "z.example"):
        menu = [f"{word()} {word()}" for _ in range(rng.randint(1, 6))]
        held = None
        for _ in range(rng.choice([1, 5, 60])):
            if held is None or rng.random() < 0.6:
                own = [" ".join(word() for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 4))]
                body = "".join(f"<p>{x}</p>" for x in [*menu, *own])
                held = f"<article>{body}</article>" if rng.random() < 0.3 else body
            rows.append((len(rows), f"http://{host}/{rng.choice('ab')}/{rng.randint(0, 30)}?q={rng.randint(0, 3)}", held))
    rng.shuffle(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        out = extract_text(spark.createDataFrame(rows, "page_id int, url string, html string")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert {r.page_id: (r.text, r.n_shared) for r in out} == plain(rows)


def test_guests_come_from_the_nearest_runs():
    """Against walking the whole order, with buckets of one run and runs over many buckets."""
    for seed in range(200):
        rng = random.Random(seed)
        pages, content = [], 0
        for k in range(rng.randint(1, 30)):
            content += rng.random() < 0.5
            pages.append((f"h{k // 12}", "/", k, content * 100 + k // 12))
        cut = sorted(rng.sample(range(1, 31), 6))
        bucket = [sum(c <= k for c in cut) for k in range(len(pages))]
        runs = [list(g) for _, g in itertools.groupby(range(len(pages)), key=lambda k: pages[k][3])]
        ends, want = {}, set()
        for b in set(bucket):
            mine = [k for k in range(len(pages)) if bucket[k] == b]
            parts = [list(g) for _, g in itertools.groupby(mine, key=lambda k: pages[k][3])]
            ends[b] = ([pages[p[0]] for p in parts[:REACH + 1]], [pages[p[-1]] for p in parts[-REACH - 1:]])
            lo = next(n for n, r in enumerate(runs) if mine[0] in r)
            hi = next(n for n, r in enumerate(runs) if mine[-1] in r)
            want |= {(pages[r[-1]], b) for r in runs[max(0, lo - REACH):lo] if pages[r[0]][0] == pages[mine[0]][0]}
            want |= {(pages[r[0]], b) for r in runs[hi + 1:hi + 1 + REACH] if pages[r[0]][0] == pages[mine[-1]][0]}
        assert set(guests_of(ends)) == want


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_any_number_of_buckets(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    first = {r.page_id: r.text for r in extract_text(pages).collect()}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        again = {r.page_id: r.text for r in extract_text(pages).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert first == again and all("<" not in t for t in first.values())
