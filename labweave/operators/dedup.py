"""Suppressing repeats: whole documents, rows of a batch, versions of a key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from labweave.operators.skew import HOT_ROWS, join_groups, split_hot_join
from labweave.session import checkpoint
from labweave.sources.config import broadcast_if_small, fits_broadcast, measured

#: A round that leaves more than this share of the open documents is followed by one along chains.
SLOW_ROUND = 0.7
#: Rows that one bitmap of Spark's holds.
CHUNK = 32_768
# Texts stored with suppressed and repeated rows.
DUPLICATE_REASON = "shares_ids_or_content_with_a_kept_document"
REPEAT_NOTE = ("repeats the value on page ", " of this document")


def _pairs(docs: DataFrame, key: str, content: str, order: str) -> DataFrame:
    """The first document of each (key, content) pair. Exact copies share both, so only their
    first can be kept; collapsing them ahead of the shuffle removes hot copy groups."""
    return docs.groupBy(F.col(key).alias("k"), F.col(content).alias("h")).agg(
        F.min(order).alias("o")
    )


def _first_of_both(pairs: DataFrame) -> DataFrame:
    """Documents that come first in their key group and in their content group."""
    by_key = pairs.groupBy("k").agg(F.min("o").alias("o"))
    by_content = pairs.groupBy("h").agg(F.min("o").alias("o"))
    return by_key.join(by_content.hint("merge"), "o")


def first_round_kept(
    docs: DataFrame, *, key: str = "dedup_key", content: str = "content_hash",
    order: str = "path_parts",
) -> DataFrame:
    """Documents nothing ahead of them in ``order`` shares a key or content with."""
    firsts = _first_of_both(_pairs(docs, key, content, order)).select(F.col("o").alias(order))
    return docs.join(firsts, order, "left_semi")


def greedy_kept(
    docs: DataFrame, *, key: str = "dedup_key", content: str = "content_hash",
    order: str = "path_parts", hot_rows: int = HOT_ROWS, seen: DataFrame | None = None,
) -> DataFrame:
    """``(order, key, content)`` of the documents kept by a pass in ``order`` that drops a
    document when its key or its content belongs to an already kept one.

    A dropped document's keys are not remembered, so this is the first maximal independent
    set of the shares-a-value graph, not its components. Documents sharing nothing are kept
    at once. Among the others each round settles every document that is first in both of its
    groups and everything sharing a value with those; rounds repeat until none is open. Where a round
    settles little, the next one also follows chains in which each document waits for one other
    (:func:`_chains_kept`), so a chain of any length takes one round. ``seen``
    adds ``(k, h)`` of documents kept earlier. Null is a value like any other here: documents
    without a key share that, whatever the sizes.
    """
    open_ = checkpoint(_pairs(docs, key, content, order), "dedup-pairs")
    if seen is not None:
        for col in ("k", "h"):
            # Reduce the long history to the values this batch has before it meets the batch.
            hit = _same_value(seen.select(col), measured(open_.select(col).distinct()), col, "left_semi")
            hit = checkpoint(hit.distinct(), "dedup-seen")
            open_ = _same_value(open_, measured(hit), col, "left_anti")
    marked = checkpoint(_mark_shared(open_, hot_rows), "dedup-marked")
    kept = [marked.filter("not shared").select("o", "k", "h")]
    open_ = marked.filter("shared").select("k", "h", "o")
    # Counting a landed table reads its footers only.
    last = None
    while n := open_.count():
        if last is not None and n > SLOW_ROUND * last:
            firsts = _chains_kept(open_, hot_rows if n > hot_rows else None)
        else:
            firsts = checkpoint(_first_of_both(open_).select("o", "k", "h"), "dedup-kept")
        last = n
        kept.append(firsts)
        for col in ("k", "h"):
            open_ = _without(open_, firsts, col, hot_rows if n > hot_rows else None)
        open_ = checkpoint(open_, "dedup-open")
    out = kept[0]
    for part in kept[1:]:
        out = out.unionByName(part)
    return out.select(F.col("o").alias(order), F.col("k").alias(key), F.col("h").alias(content))


def _chains_kept(open_: DataFrame, hot_rows: int | None) -> DataFrame:
    """Documents kept as far as chains decide it: ``o, k, h``.

    A document that is first in one group and second in the other waits for one document alone, and is
    kept just if that one is not. Pointers along these waits are doubled, each with the parity of its
    steps, until they end at a document that waits for none (kept) or for several (open). So a chain
    of n documents takes log n joins; a document is waited for by at most two, so no key is hot.
    """
    firsts = {c: open_.groupBy(c).agg(F.min("o").alias("first")) for c in ("k", "h")}
    waits = []
    for c, other in (("k", "h"), ("h", "k")):
        first = firsts[c].select(F.col(c).alias("_value"), "first")
        if hot_rows is None:
            with_first = open_.join(first.hint("merge"), F.col(c).eqNullSafe(F.col("_value")))
        else:
            with_first = split_hot_join(
                open_, firsts[c], [c], open_.groupBy(c).agg(F.count("*").alias("n")), how="inner",
                spread=["o"], hot_rows=hot_rows)
        second = with_first.filter("o > first").groupBy(c).agg(
            F.min("o").alias("o"), F.min("first").alias("at")).select("o", "at")
        alone = firsts[other].select(F.col("first").alias("o"))
        waits.append(second.join(alone.hint("merge"), "o"))
    waits = waits[0].unionByName(waits[1])
    free = _first_of_both(open_).select("o")
    # at: where the pointer is; odd: whether an odd number of steps leads there; end: it goes no further.
    steps = checkpoint(
        open_.select("o").join(waits.hint("merge"), "o", "left").join(
            free.withColumn("free", F.lit(True)).hint("merge"), "o", "left")
        .select("o", F.coalesce("at", "o").alias("at"), F.col("at").isNotNull().alias("odd"),
                F.col("at").isNull().alias("end"), F.coalesce("free", F.lit(False)).alias("free")),
        "dedup-steps")
    while not steps.filter("not end").isEmpty():
        to = steps.select(F.col("o").alias("at"), F.col("at").alias("further"), F.col("odd").alias("odder"),
                          F.col("end").alias("last"), F.col("free").alias("kept"))
        going = steps.filter("not end").join(to.hint("merge"), "at").select(
            "o", F.col("further").alias("at"), (F.col("odd") != F.col("odder")).alias("odd"),
            F.col("last").alias("end"), F.col("kept").alias("free"))
        steps = checkpoint(steps.filter("end").unionByName(going), "dedup-steps")
    return checkpoint(
        open_.join(steps.filter("free and not odd").select("o").hint("merge"), "o").select("o", "k", "h"),
        "dedup-kept")


def _mark_shared(pairs: DataFrame, hot_rows: int) -> DataFrame:
    """Add ``shared``: whether another pair has the same key or the same content."""
    marked = pairs
    for col in ("k", "h"):
        groups = pairs.groupBy(col).agg(F.count("*").alias("n")).filter("n > 1")
        marked = join_groups(marked, groups.withColumn(f"shared_{col}", F.lit(True)), [col],
                             spread=["o"], hot_rows=hot_rows)
    return marked.select(
        "o", "k", "h", F.coalesce("shared_k", "shared_h", F.lit(False)).alias("shared"))


def _same_value(left: DataFrame, right: DataFrame, col: str, how: str) -> DataFrame:
    """Semi or anti join on one column in which null equals null."""
    other = right.select(F.col(col).alias("_value"))
    return left.join(other, F.col(col).eqNullSafe(F.col("_value")), how)


def _without(open_: DataFrame, kept: DataFrame, col: str, hot_rows: int | None) -> DataFrame:
    if hot_rows is None:  # fewer rows in all than a hot key would have
        return _same_value(open_, measured(kept.select(col)), col, "left_anti").select("k", "h", "o")
    counts = open_.groupBy(col).agg(F.count("*").alias("n"))
    return split_hot_join(
        open_, kept.select(col), [col], counts, how="left_anti", spread=["o"], hot_rows=hot_rows
    )


def dedup_documents(
    docs: DataFrame, *, key: str = "dedup_key", content: str = "content_hash",
    order: str = "path_parts", enabled: bool = True, hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """``(kept, suppressed)`` documents. What is dropped is mostly the smaller part, so that
    list meets the documents, whose bodies then stay where they are."""
    if not enabled:
        docs = docs.drop("_file", "_row")
        return docs, docs.filter(F.lit(False))
    kept = greedy_kept(docs, key=key, content=content, order=order, hot_rows=hot_rows)
    return split_by_kept(docs, kept, order)


def split_by_kept(docs: DataFrame, kept: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """``(kept, dropped)``. Of documents that carry their place in landed files (:func:`placed`) no body
    is moved: a bitmap per file and ``CHUNK`` rows says which go."""
    there = {"_file", "_row"} <= set(docs.columns)
    gone = docs.select(order, *["_file", "_row"] * there).join(
        kept.select(order).hint("merge"), order, "left_anti")
    if there:
        # A null order meets no other, so such a document stays.
        bits = _bits(gone.filter(F.col(order).isNotNull()).select("_file", "_row"), _dropped=F.lit(True))
        marked, own = _meet_bits(docs, bits), [c for c in docs.columns if c not in ("_file", "_row")]
        is_gone = F.col("_in").isNotNull() & _bit("_dropped")
        return marked.filter(~is_gone).select(*own), marked.filter(is_gone).select(*own)
    gone = checkpoint(gone, "dedup-gone")
    # Beyond the broadcast bound the list is hashed, so that no bodies are sorted.
    gone = F.broadcast(gone) if fits_broadcast(gone) else gone.hint("shuffle_hash")
    return docs.join(gone, order, "left_anti"), docs.join(gone, order, "left_semi")


def placed(landed: DataFrame) -> DataFrame:
    """A table as landed, each row with its place: ``_file`` and ``_row``."""
    return landed.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def _place() -> Column:
    return F.col("_row") % CHUNK


def _bits(places: DataFrame, **bitmaps: Column) -> DataFrame:
    """Per file and ``CHUNK`` rows a bitmap of the places at which each condition holds, landed: for a
    broadcast, if they measure small."""
    noted = checkpoint(places.groupBy(
        F.col("_file").alias("_in"), F.floor(F.col("_row") / CHUNK).alias("_chunk")).agg(
        *[F.bitmap_construct_agg(F.when(c, _place())).alias(name) for name, c in bitmaps.items()]),
        "place-bits")
    return F.broadcast(noted) if fits_broadcast(noted) else noted.hint("shuffle_hash")


def _meet_bits(rows: DataFrame, bits: DataFrame) -> DataFrame:
    here = (F.col("_file") == F.col("_in")) & (F.floor(F.col("_row") / CHUNK) == F.col("_chunk"))
    return rows.join(bits, here, "left")


def _bit(bitmap: str) -> Column:
    byte = F.substring(bitmap, F.floor(_place() / 8).cast("int") + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), _place() % 8) == 1


def suppressed_rows(suppressed: DataFrame) -> DataFrame:
    return suppressed.select(
        "file_path", "clinic_id", "dedup_key", F.lit(DUPLICATE_REASON).alias("reason")
    )


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], *,
               hot_rows: int = HOT_ROWS) -> DataFrame:
    """The first row per key. An aggregate, not a ranking window: each task sends one row per
    key, so a key with many copies does not meet in one place."""
    return _of_repeated(df, keys, order, F.min, F.min_by, hot_rows)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], *,
              hot_rows: int = HOT_ROWS) -> DataFrame:
    """The last row per key, e.g. the latest run or the latest version."""
    return _of_repeated(df, keys, order, F.max, F.max_by, hot_rows)


def keep_first_landed(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], *,
                      hot_rows: int = HOT_ROWS, short: Mapping[str, Column] | None = None) -> DataFrame:
    """:func:`keep_first` of a table as landed, whose rows stay where they are.

    Only keys, order and place in the files are moved. Which rows repeat a key, and which of those are the
    first, is noted as two bitmaps per file and ``CHUNK`` rows, which the rows then meet by file: a
    broadcast, if they measure small. Of rows equal in order the place decides. ``short`` gives keys a
    shorter value to be moved, which differs wherever the key does.
    """
    there = placed(df)
    narrow = there.withColumns(dict(short or {})).select(*keys, F.struct(*order).alias("_order"), "_file", "_row")
    many, on = _repeated_keys(df.withColumns(dict(short or {})), keys)
    if fits_broadcast(many):
        repeated = narrow.join(F.broadcast(many.drop("_n")), on, "left_semi")
    else:
        others, hot_ones, keyed = _hot_apart(narrow, many, on, hot_rows)
        repeated = others.join(keyed, on, "left_semi").unionByName(hot_ones)
    repeated = checkpoint(repeated, "repeated-places")
    first = repeated.groupBy(*keys).agg(F.min(F.struct("_order", "_file", "_row")).alias("_first")).select(
        "_first._file", "_first._row", F.lit(True).alias("is_first"))
    bits = _bits(
        repeated.select("_file", "_row", F.lit(False).alias("is_first")).unionByName(first),
        _repeated=~F.col("is_first"), _firsts=F.col("is_first"))
    return _meet_bits(there, bits).filter(
        F.col("_in").isNull() | ~_bit("_repeated") | _bit("_firsts")).select(*df.columns)


def _repeated_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """The keys that occur more than once, landed with their count, and how rows meet them."""
    many = checkpoint(
        df.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").select(
            *[F.col(k).alias(f"_m_{k}") for k in keys], "_n"), "repeated")
    return many, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_m_{k}")) for k in keys])


def _hot_apart(rows: DataFrame, many: DataFrame, on: Column, hot_rows: int
               ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of no hot key, those of hot ones, and the other repeated keys for a hashed join."""
    hot = broadcast_if_small(many.filter(F.col("_n") > hot_rows).drop("_n"))
    keyed = many.filter(F.col("_n") <= hot_rows).drop("_n").hint("shuffle_hash")
    return rows.join(hot, on, "left_anti"), rows.join(hot, on, "left_semi"), keyed


def _of_repeated(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], best, best_by,
                 hot_rows: int) -> DataFrame:
    """The best row of each key that occurs more than once, all other rows as they are.

    The repeated keys are found on the key columns alone and landed. While they fit a broadcast, no
    other row is moved. Beyond that rows meet them by key in hashed, unsorted joins; rows of a key with
    more than ``hot_rows`` stay where they are, since such keys are few.
    """
    many, on = _repeated_keys(df, keys)
    if fits_broadcast(many):
        many = F.broadcast(many.drop("_n"))
        rows = df.join(many, on, "left_semi")
        best_rows = rows.groupBy(*keys).agg(
            best_by(F.struct(*df.columns), F.struct(*order)).alias("_r")).select("_r.*")
        return df.join(many, on, "left_anti").unionByName(best_rows)
    others, hot_ones, keyed = _hot_apart(df, many, on, hot_rows)
    repeated = others.join(keyed, on, "left_semi").unionByName(hot_ones)
    return others.join(keyed, on, "left_anti").unionByName(
        _best_landed(checkpoint(repeated, "repeated-rows"), keys, order, best))


def _best_landed(rows: DataFrame, keys: Sequence[str], order: Sequence[Column | str], best) -> DataFrame:
    """The best of each key's rows in a landed table: only keys, order and place in the files are
    sorted, whole rows are looked up by place. Of equal rows the place decides."""
    there = placed(rows)
    won = there.groupBy(*keys).agg(best(F.struct(
        F.struct(*order).alias("_order"), "_file", "_row")).alias("_best")).select(
        F.col("_best._file").alias("_won_file"), F.col("_best._row").alias("_won_row"))
    return there.join(
        won.hint("shuffle_hash"), (F.col("_file") == F.col("_won_file")) & (F.col("_row") == F.col("_won_row")),
        "left_semi").drop("_file", "_row")


def flag_repeats(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], *, page: str = "page_number",
    reason: str = "flag_reason", flag: str = "duplicate_within_report",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Flag every row after the first with equal ``keys`` and note the first one's page.

    The first row of each group is found by a partial aggregate and sent back to the rows of
    groups that have a repeat, so a group may be of any size. Null keys equal each other. Beyond the
    broadcast bound rows that carry their place (:func:`placed`) stay where they are: only keys, order and
    place meet the groups, a bitmap tells which rows are flagged, and these alone are looked up.
    """
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    there = {"_file", "_row"} <= set(df.columns)
    own = [c for c in df.columns if c != flag and not (there and c in ("_file", "_row"))]
    stats = df.groupBy(*keys).agg(
        F.min(place).alias("_first"), F.min_by(page, place).alias("_page"),
        F.count("*").alias("n"),
    )
    note = F.concat(
        F.lit(REPEAT_NOTE[0]),
        F.coalesce(F.col("_page").cast("string"), F.lit("None")),
        F.lit(REPEAT_NOTE[1]),
    )
    noted = F.concat_ws("; ", F.nullif(F.col(reason), F.lit("")), note)
    again = F.coalesce(place > F.col("_first"), F.lit(False))
    groups = stats.filter("n > 1")
    if there:
        groups = checkpoint(groups, "repeat-groups")
        if not fits_broadcast(groups):
            narrow = df.select(*dict.fromkeys([*keys, *order]), "_file", "_row")
            repeats = checkpoint(split_hot_join(
                narrow, groups.drop("n"), keys, groups.select(*keys, "n"), how="inner", spread=list(order),
                hot_rows=hot_rows).filter(again).select("_file", "_row", "_page"), "repeats")
            marked = _meet_bits(df, _bits(repeats, _again=F.lit(True)))
            is_again = F.col("_in").isNotNull() & _bit("_again")
            pages = repeats.select(F.col("_file").alias("_at"), F.col("_row").alias("_at_row"), "_page")
            flagged = marked.filter(is_again).join(
                pages.hint("shuffle_hash"), (F.col("_file") == F.col("_at")) & (F.col("_row") == F.col("_at_row")))
            return marked.filter(~is_again).select(*own, F.lit(False).alias(flag)).unionByName(
                flagged.withColumns({flag: F.lit(True), reason: noted}).select(*own, flag))
    joined = join_groups(df, groups, keys, spread=list(order), hot_rows=hot_rows)
    return joined.withColumns({
        flag: again, reason: F.when(again, noted).otherwise(F.col(reason))}).select(*own, flag)
