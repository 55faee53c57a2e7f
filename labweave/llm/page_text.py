"""Main text of web pages by nearest-URL page differencing.

Pages are ordered by host, path and id. Neighbours with equal lines are one run, so that copies
never hide a page's siblings. A page's candidates are the ``REACH`` runs ahead of its own and the
``REACH`` behind, within its host, longer common path start first (ties: the nearer, then the one
ahead). The text lines of page and candidate are aligned by longest common subsequence.

- A candidate is a copy if what the two do *not* share is alike (half the five-word shingles
  of the smaller rest) or next to nothing (a tenth of the shared words): copies delete nothing.
- The nearest candidate that is no copy is the partner of every page, marked up or not; lines shared
  with it are the site's own, not the page's, and are deleted.
- Inside an article (or main) element a passage that some pages share may well be the article's own,
  so a check gives these lines back. What stays deleted are the lines at its start and end that all
  candidates share, copies aside, if these are ``EDGE`` lines or more and ``SEVERAL`` candidates or more.
- Menus, headers, footers, sidebars, notices, adverts, forms, scripts and reader comments that the
  markup names go even if no other page has them.

Keys are landed and the pages travel once, as lines. The order is cut into buckets at quantiles of a
sample of keys, ``SAMPLE_PER_BUCKET`` each, as many as the lines' bytes need; a bucket also gets the last page of each
of the ``REACH`` runs ahead of it and the first of those behind, so every page meets its true
neighbours wherever the cuts lie. A task streams through sorted pages and holds a few runs.

Null or empty html gives an empty text; a null url has no host and no path; equal urls are told
apart by page id; repeated rows each get a row; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from itertools import takewhile

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import IntegerType, StringType

from labweave.llm.common import hash_sample, in_arrow
from labweave.llm.url_rules import split_url
from labweave.session import checkpoint

#: Sampled keys per bucket, buckets per shuffle partition, bytes of lines per shuffle partition.
SAMPLE_PER_BUCKET = 5
BUCKETS_PER_PARTITION = 8
PARTITION_BYTES = 64 << 20
#: Runs looked at on either side; candidates that must share an article's edges, and lines of these.
REACH = 2
SEVERAL = 2
EDGE = 4
#: A candidate is a copy if this part of the smaller rest's shingles is in the other rest, or if
#: both rests have at most this part of the words that the two share.
COPY_WORDS = 5
COPY_ALIKE = 0.5
COPY_REST = 0.1

MARKED, MAIN, OTHER = 0, 1, 2

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|textarea|svg|iframe|select|title)\b[^>]*>"
    r".*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*>"
    r"""|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<rest>(?:"[^"]*"|'[^']*'|[^>"'])*)>""",
    re.S | re.I)
_ATTRIBUTE = re.compile(
    r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)

_HOLDERS = frozenset(
    "html head body div section article main nav aside header footer form ul ol dl table figure "
    "dialog menu details fieldset address center".split())
_BLOCKS = _HOLDERS | frozenset(
    "p h1 h2 h3 h4 h5 h6 li dt dd tr caption blockquote pre hr figcaption summary thead tbody "
    "tfoot legend".split())
_SPACES = frozenset("br td th option img input".split())
_MARKED_TAGS = frozenset("head nav aside footer form dialog menu button".split())
_MARKED_WORDS = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer ad ads advert adverts "
    "advertisement sponsor sponsored promo promotion banner cookie cookies consent gdpr notice "
    "notices popup modal overlay newsletter subscribe signup share sharing social related "
    "recommended comment comments commentlist disqus replies respond pagination pager widget "
    "toolbar skip login search complementary contentinfo".split())
#: Headers of a page, not of an article.
_OUTER_WORDS = frozenset("header masthead topbar banner".split())


def _words(rest: str, whole: bool) -> set[str]:
    """Words of class, id and role; ``whole`` leaves hyphenated names together."""
    out: set[str] = set()
    for name, a, b, c in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            out.add("popup")
        elif name != "aria-hidden":
            out.update(value.split() if whole else re.split(r"[\s_-]+", value))
    return out


def page_lines(page: str) -> list[tuple[str, int]]:
    """Text blocks of a page in order with their zone: MARKED, MAIN or OTHER."""
    lines: list[tuple[str, int]] = []
    held: list[str] = []
    stack: list[tuple[str, int]] = []
    zone, at = OTHER, 0

    def close() -> None:
        if held:
            text = " ".join(entities.unescape("".join(held)).split())
            if text:
                lines.append((text, zone))
            held.clear()

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            held.append(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _SPACES:
            held.append(" ")
        if tag not in _BLOCKS and tag != "button":
            continue
        close()
        if tag not in _HOLDERS and tag != "button":
            continue
        if m["end"]:
            k = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), None)
            if k is not None:
                zone = stack[k][1]
                del stack[k:]
            continue
        if m["rest"].endswith("/") and tag not in ("div", "p"):
            continue
        stack.append((tag, zone))
        if zone != MARKED:
            outer = tag in ("html", "body", "article", "main")
            words = _words(m["rest"], outer) if m["rest"] else set()
            if tag in _MARKED_TAGS or (words & _MARKED_WORDS and tag not in ("html", "body")):
                zone = MARKED
            elif zone == OTHER and (tag == "header" or words & _OUTER_WORDS) and not outer:
                zone = MARKED
            elif tag in ("article", "main"):
                zone = MAIN
    if at < len(page):
        held.append(page[at:])
    close()
    return lines


def common_lines(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places in ``a`` and ``b`` of a longest common subsequence: increasing runs over the places of
    each line in ``b``."""
    places: dict[str, list[int]] = {}
    for j, line in enumerate(b):
        places.setdefault(line, []).append(j)
    ends: list[int] = []
    links: list[tuple] = []
    for i, line in enumerate(a):
        for j in reversed(places.get(line, ())):
            k = bisect_left(ends, j)
            link = ((i, j), links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            elif ends[k] != j:
                ends[k], links[k] = j, link
    out: list[tuple[int, int]] = []
    link = links[-1] if links else None
    while link:
        out.append(link[0])
        link = link[1]
    return out[::-1]


def pack(lines: list[tuple[str, int]]) -> str:
    """Lines as one text; a line has no line break of its own."""
    return "\n".join(f"{z}{t}" for t, z in lines)


def unpack(packed: str) -> list[tuple[str, int]]:
    return [(x[1:], int(x[0])) for x in packed.split("\n")] if packed else []


def _shingles(lines: list[str]) -> set[tuple[str, ...]]:
    """Distinct word shingles of the lines (fewer words: the whole line)."""
    out = set()
    for line in lines:
        ws = line.split()
        out.update(tuple(ws[k:k + COPY_WORDS]) for k in range(max(1, len(ws) - COPY_WORDS + 1)))
    return out


def shared_lines(here: list[str], other: list[str]) -> set[int] | None:
    """Indices of ``here`` that are shared with ``other``; None if ``other`` is a copy."""
    pairs = common_lines(here, other)
    shared, back = {i for i, _ in pairs}, {j for _, j in pairs}
    if not shared:
        return shared  # nothing to delete, whether it is a copy or not
    rest = [t for i, t in enumerate(here) if i not in shared]
    theirs = [t for j, t in enumerate(other) if j not in back]
    most = max(sum(len(t.split()) for t in x) for x in (rest, theirs))
    if most <= COPY_REST * sum(len(here[i].split()) for i in shared):
        return None
    a, b = _shingles(rest), _shingles(theirs)
    least = min(len(a), len(b))
    if least and len(a & b) >= COPY_ALIKE * least:
        return None
    return shared


def main_text(
    lines: list[tuple[str, int]], found: Iterable[set[int] | None]
) -> tuple[str, int]:
    """What is left of a page after its differences with its candidates, nearest first
    (:func:`shared_lines` of each), and the number of lines that the differences alone removed.

    Every page loses the lines that it shares with its partner. Those of an article come back unless
    they are the site's edges of it; what the markup names goes in any case."""
    sets = (x for x in found if x is not None)
    deleted = partner = next(sets, set())
    inside = [i for i, (_, z) in enumerate(lines) if z == MAIN]
    if inside:
        deleted = _edges(inside, [partner])
        if len(deleted) >= EDGE:
            others = list(sets)
            deleted = _edges(inside, [partner, *others]) if 1 + len(others) >= SEVERAL else set()
        if len(deleted) < EDGE:
            deleted = set()
    own = inside or [i for i, (_, z) in enumerate(lines) if z == OTHER]
    return ("\n\n".join(lines[i][0] for i in own if i not in deleted),
            sum(i in deleted for i in own))


def _edges(inside: list[int], sets: list[set[int]]) -> set[int]:
    """The lines at the start and end of an article that are in all ``sets``."""
    shared = set.intersection(*sets)
    return {i for side in (inside, inside[::-1]) for i in takewhile(shared.__contains__, side)}


def _alike(a: str, b: str) -> int:
    """Length of the common start."""
    for k, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return k
    return min(len(a), len(b))


@F.pandas_udf(StringType())
def _lines_of(html: pd.Series) -> pd.Series:
    return html.map(lambda page: pack(page_lines(page or "")))


def _placed(pages: DataFrame) -> DataFrame:
    """``page_id, url, host, path, id, html``."""
    host, path = split_url(F.col("url"))
    return pages.select("page_id", "url", "html", host.alias("host"), path.alias("path"),
                        F.coalesce(F.col("page_id").cast("long"), F.lit(-1)).alias("id"))


def _parsed(placed: DataFrame) -> DataFrame:
    """``page_id, url, at, lines``: ``at`` sorts pages, its content tells runs apart."""
    return placed.withColumn("lines", _lines_of("html")).select("page_id", "url", F.struct(
        "host", "path", "id", F.xxhash64("host", "lines").alias("content")).alias("at"), "lines")


_AT = "struct<host: string, path: string, id: long, content: long>"
_KEY = ("host", "path", "id", "content")


def _bucket_ends(placed: DataFrame, parts: int) -> dict[int, tuple[list, list]]:
    """Per bucket the first page of each of its first runs, and the last page of each of its last
    ones, one run more than ``REACH``: a run may go on across the cut."""
    keys = placed.select("to", *_KEY).repartition(parts, "to").sortWithinPartitions("to", *_KEY)
    most = REACH + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends: dict[int, tuple[list, list]] = {}
        for b in batches:
            for to, *at in zip(*[b.column(c).to_pylist() for c in ("to", *_KEY)]):
                head, tail = ends.setdefault(to, ([], []))
                at = tuple(at)
                if tail and tail[-1][3] == at[3]:
                    tail[-1] = at
                    continue
                tail.append(at)
                del tail[:-most]
                if len(head) < most:
                    head.append(at)
        if ends:
            rows = [(to, front, at) for to, sides in ends.items()
                    for front, side in zip((True, False), sides) for at in side]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows])]
                + [pa.array([r[2][k] for r in rows]) for k in range(4)],
                names=["to", "front", *_KEY])

    out: dict[int, tuple[list, list]] = {}
    for r in in_arrow(keys, run, "to int, front boolean, host string, path string, id long, "
                                 "content long").collect():  # a few rows per bucket
        out.setdefault(r.to, ([], []))[0 if r.front else 1].append(tuple(r[2:]))
    return {to: (sorted(head), sorted(tail)) for to, (head, tail) in sorted(out.items())}


def guests_of(ends: dict[int, tuple[list, list]]) -> list[tuple[tuple, int]]:
    """Pages that a bucket gets from other buckets: the nearest ones of the runs next to it."""
    out = []
    for order, own, far in ((sorted(ends), 0, 1), (sorted(ends, reverse=True), 1, 0)):
        near: list[tuple] = []  # one page per run, nearest last
        for b in order:
            first = ends[b][own][0 if own == 0 else -1]
            runs = near[:-1] if near and near[-1][3] == first[3] else near
            out += [(at, b) for at in runs[-REACH:] if at[0] == first[0]]
            for at in ends[b][far] if far else ends[b][far][::-1]:
                if near and near[-1][3] == at[3]:
                    near[-1] = at
                else:
                    near.append(at)
            del near[:-REACH - 1]
    return out


class _Run:
    """Neighbouring pages with the same lines; ``first`` and ``last`` are their outer paths."""

    def __init__(self, row: dict):
        self.key = (row["to"], row["host"])
        self.content, self.lines = row["content"], unpack(row["lines"])
        self.texts = [t for t, _ in self.lines]
        self.first = self.last = row["path"]
        self.rows: list[tuple] = []
        self.found: dict[int, set[int] | None] = {}
        self.results: dict[tuple, tuple[str, int, int]] = {}

    def add(self, row: dict) -> None:
        self.last = row["path"]
        if row["own"]:
            self.rows.append((row["page_id"], row["url"], row["path"]))

    def result(self, path: str, near: list[tuple[_Run, str]]) -> tuple[str, int, int]:
        """Text of a page at ``path``, lines removed and lines shared with its partner; ``near`` holds
        runs with their nearest path, nearest first."""
        order = tuple(sorted(
            (k for k, (r, _) in enumerate(near) if r.content != self.content),
            key=lambda k: -_alike(path, near[k][1])))
        if order not in self.results:
            partner = next((x for k in order if (x := self.shared(k, near)) is not None), set())
            self.results[order] = (
                *main_text(self.lines, (self.shared(k, near) for k in order)), len(partner))
        return self.results[order]

    def shared(self, k: int, near: list[tuple[_Run, str]]) -> set[int] | None:
        if k not in self.found:
            self.found[k] = shared_lines(self.texts, near[k][0].texts)
        return self.found[k]


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars, n_shared, n_partner`` for every row of ``pages`` (page_id, url,
    html); ``n_shared`` lines were removed for being shared alone, ``n_partner`` lines, marked ones
    among them, are shared with the page's partner."""
    spark = pages.sparkSession
    kinds = dict(pages.dtypes)
    placed = _placed(pages)
    parsed = _parsed(placed)
    keys = checkpoint(parsed.select("at.*", F.octet_length("lines").alias("size")), "page-keys")
    n_bytes = keys.agg(F.sum("size")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_bytes // PARTITION_BYTES))
    n = parts * BUCKETS_PER_PARTITION
    sample = sorted(tuple(r) for r in hash_sample(  # as many keys as the buckets need
        keys.drop("size"), n * SAMPLE_PER_BUCKET, *map(F.col, _KEY)).collect())
    cuts = sorted(set(sample[SAMPLE_PER_BUCKET::SAMPLE_PER_BUCKET]))

    @F.pandas_udf(IntegerType())
    def bucket_of(at: pd.DataFrame) -> pd.Series:
        return pd.Series([bisect_right(cuts, k) for k in zip(*[at[c] for c in _KEY])], dtype="int32")

    ends = _bucket_ends(keys.withColumn("to", bucket_of(F.struct(*_KEY))), parts)
    guests = spark.createDataFrame(guests_of(ends), f"at {_AT}, to int")
    sent = parsed.select("page_id", "url", "lines", "at.*", bucket_of("at").alias("to"),
                         F.lit(True).alias("own"))
    # Only pages at a guest's place are parsed for it.
    near = placed.join(F.broadcast(guests.select("at.host", "at.path", "at.id").distinct()),
                       ["host", "path", "id"], "left_semi")
    visits = _parsed(near).select("at", "lines").join(
        F.broadcast(guests), "at").dropDuplicates(["at", "to"])
    sent = sent.unionByName(visits.select(
        F.lit(None).cast(kinds["page_id"]).alias("page_id"),
        F.lit(None).cast("string").alias("url"), "lines", "at.*", "to", F.lit(False).alias("own")))
    sorted_pages = sent.repartition(parts, "to").sortWithinPartitions("to", *_KEY, "url")
    names = ["page_id", "url", "text", "n_chars", "n_shared", "n_partner"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_type = None
        out: list[tuple] = []

        def done(runs: list[_Run], k: int) -> None:
            """Rows of the run at place ``k``, which knows its neighbours now."""
            here = runs[k]
            near = []
            for d in range(1, REACH + 1):
                if k >= d:
                    near.append((runs[k - d], runs[k - d].last))
                if k + d < len(runs):
                    near.append((runs[k + d], runs[k + d].first))
            for page_id, url, path in here.rows:
                text, n_shared, n_partner = here.result(path, near)
                out.append((page_id, url, text, len(text), n_shared, n_partner))

        def flush() -> pa.RecordBatch:
            types = [id_type, pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            cols = list(zip(*out))
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)], names=names)

        runs: list[_Run] = []  # of one bucket and host; the last REACH of them are not done
        n_done = 0
        for b in batches:
            id_type = b.schema.field("page_id").type
            for row in b.to_pylist():
                if runs and runs[-1].key != (row["to"], row["host"]):
                    for k in range(n_done, len(runs)):
                        done(runs, k)
                    runs, n_done = [], 0
                if not runs or runs[-1].content != row["content"]:
                    runs.append(_Run(row))
                    if len(runs) - n_done > REACH:
                        # The newest run is known by its first page, which is all that it takes.
                        done(runs, n_done)
                        n_done += 1
                    if n_done > REACH:
                        del runs[0]
                        n_done -= 1
                runs[-1].add(row)
                if len(out) >= 256:
                    yield flush()
        for k in range(n_done, len(runs)):
            done(runs, k)
        if out:
            yield flush()

    return in_arrow(sorted_pages, run, f"page_id {kinds['page_id']}, url string, text string, "
                                       "n_chars long, n_shared long, n_partner long")
