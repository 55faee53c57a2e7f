"""Quality rules with cross-document line frequency, in DataFrame functions alone.

Per document: word, symbol, repeated-line and repeated-window counts, which decide
``base_failed``. Across documents: lines are normalised (lower case, white space squeezed) and
hashed; per host the distinct texts of a line are counted. A line above its host's limit is
frequent and removed (``trim``), and a document left with too little is rejected.

Exact copies of a text are no boilerplate: they count as one text, in a line's count as in its
host's size, and are left to the near-duplicate operator. A block of lines that many different
texts share is frequent line by line, however its lines stand to each other.

Null or empty text has no words and fails; a null host is a host of its own; repeated rows
all get the same result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from labweave.llm.common import row_key
from labweave.session import checkpoint
from labweave.sources.config import fits_broadcast

#: Characters that count as symbols, white space as a pattern, and a word's first character.
SYMBOLS = "#*$%&|<>"
SPACE = r"[ \t-\r]+"
WORD = r"[^ \t-\r]"
WINDOW = 5
RESULT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
          "depleted", "kept"]


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    return F.array_remove(F.split(text, SPACE), "")


def _after(array: str) -> Column:
    """The array without its first element."""
    return F.slice(F.col(array), F.lit(2), F.greatest(F.size(array) - 1, F.lit(0)))


def with_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` plus n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of ``text``.

    A 5-word window is known by a 64-bit hash. Only texts with a repeated window are sorted.
    Each step is a projection of its own, so that Catalyst computes its arrays once.
    """
    df = docs.select(*keep, "text", words_of(F.col("text")).alias("words"))
    df = df.select(
        *keep, "text", F.size("words").alias("n_words"),
        F.array_join("words", "").alias("joined"),
        F.when(F.size("words") >= WINDOW, F.transform(
            F.sequence(F.lit(0), F.size("words") - WINDOW),
            lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)]),
        )).otherwise(F.array().cast("array<bigint>")).alias("windows"))
    df = df.select(
        *keep, "n_words", "joined",
        F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"),
        F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.sort_array(F.transform("windows", lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
        ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")).alias("sorted"))
    df = df.select(
        *keep, "n_words", "joined", "lines",
        F.sort_array(F.array_distinct(F.flatten(F.filter(
            F.zip_with("sorted", _after("sorted"),
                       lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))),
            lambda x: x.isNotNull())))).alias("at"))
    counts = F.struct(
        F.col("n_words").cast("long").alias("n_words"),
        F.length("joined").cast("long").alias("word_chars"),
        F.when(F.col("joined").rlike(f"[{SYMBOLS}]"),
               F.length("joined") - F.length(F.translate("joined", SYMBOLS, ""))
               ).otherwise(0).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(
            F.zip_with("at", _after("at"),
                       lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))),
            F.lit(0), lambda s, x: s + x).cast("long").alias("n_repeat_words"))
    # A generator: filters on the counts stay above it. Pushed into the projections below, they
    # would compute the word array again for every window.
    return df.select(*keep, F.inline(F.array(counts)))


def line_rows(docs: DataFrame) -> DataFrame:
    """One row per line with a word: ``row, host, doc, n_words, i, no, line, words, around, first``.

    ``i`` numbers these lines, ``no`` all lines of the text.
    ``line`` hashes the normalised line, ``around`` its two neighbours, ``doc`` the whole text;
    ``first`` marks a line's first place in its document, ``n_words`` counts the document's words.
    """
    texts = docs.select("row", "host", F.xxhash64("text").alias("doc"), F.transform(
        F.filter(F.transform(F.split("text", "\n"), lambda x, no: F.struct(
            x.alias("x"), no.alias("no"))), lambda s: s["x"].rlike(WORD)),
        lambda s: F.struct(F.lower(F.trim(F.regexp_replace(s["x"], SPACE, " "))).alias("x"),
                           s["no"].alias("no"))).alias("lines"))
    lines = texts.select("row", "host", "doc", F.transform("lines", lambda s: F.struct(
        F.xxhash64(s["x"]).alias("h"), s["no"].alias("no"),
        (F.length(s["x"]) - F.length(F.replace(s["x"], F.lit(" "), F.lit(""))) + 1).alias("w"),
    )).alias("lines"))
    placed = lines.select(
        "row", "host", "doc",
        F.aggregate("lines", F.lit(0), lambda s, x: s + x["w"]).alias("n_words"),
        F.sort_array(F.transform("lines", lambda x, i: F.struct(
            x["h"].alias("line"), i.alias("i"), x["no"].alias("no"), x["w"].alias("words"),
            F.xxhash64(F.get("lines", i - 1)["h"], F.get("lines", i + 1)["h"]).alias("around"),
        ))).alias("placed"))
    rows = placed.select("row", "host", "doc", "n_words", F.explode(F.zip_with(
        "placed", F.concat(F.array(F.lit(None).cast("bigint")), F.col("placed.line")),
        lambda a, b: F.when(a.isNotNull(), F.struct(
            a["line"].alias("line"), a["i"].alias("i"), a["no"].alias("no"), a["words"].alias("words"),
            a["around"].alias("around"), (~a["line"].eqNullSafe(b)).alias("first"),
        )))).alias("x"))
    return rows.filter("x is not null").select("row", "host", "doc", "n_words", "x.*")


def frequent_lines(
    lines: DataFrame, *, min_docs: int = 20, host_share: float = 0.01, spread: float | None = None
) -> DataFrame:
    """``host, line, n_docs`` of lines in more different texts of their host than the limit.

    The limit is the larger of ``min_docs`` and ``host_share`` of the host's texts with a line.
    Counting goes through (host, line, text), so even one line in every document is counted by
    many tasks. A ``spread`` also asks for more than that share of different surroundings, which
    spares every block of lines that stay together.
    """
    texts = lines.filter("first").groupBy("host", "line", "doc").agg(F.first("around").alias("around"))
    around = [] if spread is None else [F.count_distinct("around").alias("n_around")]
    counts = texts.groupBy("host", "line").agg(F.count("*").alias("n_docs"), *around)
    many = counts.filter(F.col("n_docs") > min_docs)
    if spread is not None:
        many = many.filter(F.col("n_around") > F.col("n_docs") * spread)
    sizes = lines.filter("i = 0").select("host", "doc").distinct().groupBy("host").agg(
        F.count("*").alias("docs"))
    return many.join(sizes, "host").filter(F.col("n_docs") > F.col("docs") * host_share).select(
        "host", "line", "n_docs")


def cut_rows(lines: DataFrame, common: DataFrame, *, min_left_pct: int) -> DataFrame:
    """``row, cut, hit`` of documents with ``common`` lines: the numbers of these lines, and whether
    too few of the document's words are outside them."""
    gone = lines.join(common.select("host", "line"), ["host", "line"])
    once = gone.groupBy("row", "no").agg(  # repeated rows collapse
        F.max("words").alias("words"), F.max("n_words").alias("n_words"))
    return once.groupBy("row").agg(
        F.collect_list("no").alias("cut"),
        (100 * (F.max("n_words") - F.sum("words")) < min_left_pct * F.max("n_words")).alias("hit"))


def without_lines(text: Column, cut: Column) -> Column:
    """The text without the lines numbered in ``cut``, the others in order; all if it is null."""
    return F.when(cut.isNull(), text).otherwise(F.array_join(F.filter(
        F.split(text, "\n"), lambda x, no: ~F.array_contains(cut, no)), "\n"))


def quality_rules(
    docs: DataFrame, *, host: str = "source", keep: Sequence[str] = (), min_docs: int = 20,
    host_share: float = 0.01, spread: float | None = None, min_words: int = 10,
    max_repeat_pct: int = 20, min_left_pct: int = 20, trim: bool = False,
) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text`` and the host column).

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeat_pct`` percent of
    them in windows found twice. ``depleted``: without the frequent lines fewer than
    ``min_left_pct`` percent of the words are left (a short text with one shared line is none).
    ``kept``: neither. Columns named in ``keep`` (none of the result's) come first, as they are;
    with ``trim`` a ``text`` among them comes without its frequent lines.
    """
    if clash := {c.lower() for c in keep} & set(RESULT):
        raise ValueError(f"rename the columns {sorted(clash)} to keep them")
    src = docs.select(
        *[F.col(c).alias(f"_keep_{c}") for c in keep],
        "doc_id", F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        row_key(F.col("doc_id"), F.col(host), F.col("text")).alias("row"))
    lines = checkpoint(line_rows(src), "lines")
    common = frequent_lines(lines, min_docs=min_docs, host_share=host_share, spread=spread)
    cuts = cut_rows(lines, common, min_left_pct=min_left_pct)
    cuts = checkpoint(cuts if trim else cuts.filter("hit").select("row", "hit"), "cuts")
    if fits_broadcast(cuts):
        cuts = F.broadcast(cuts)
    counted = with_counts(src, [*[f"_keep_{c}" for c in keep], "doc_id", "row"])
    failed = (F.col("n_words") < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    depleted = F.coalesce("hit", F.lit(False))
    kept_text = lambda c: (
        without_lines(F.col(f"_keep_{c}"), F.col("cut")) if trim and c == "text" else F.col(f"_keep_{c}"))
    return counted.join(cuts, "row", "left").select(
        *[kept_text(c).alias(c) for c in keep], *([] if "doc_id" in keep else ["doc_id"]),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), depleted.alias("depleted"), (~failed & ~depleted).alias("kept"))
