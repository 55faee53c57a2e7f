"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns ``vnodes`` points of a ring of 64-bit hashes; a row belongs to the arc that ends
at the next point clockwise. Every shard's capacity is its even share: with n rows and k shards,
ceil(n / k) for the first n mod k shards and floor(n / k) for the rest, so counts are at most one
apart. Rows that find their shard full go on clockwise to the next shard with room; all others
stay where plain consistent hashing puts them.

Only counts are planned centrally: one per arc, shards * vnodes of them however many rows there
are. Rows are ordered within small cells of an arc, never in one task per shard or arc.

A null text has size 1 and the crc of the empty text; a null id has a place on the ring of its
own; repeated rows each get a slot; ties are ordered by all columns, so only equal rows are
interchangeable; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from labweave.llm.common import row_key
from labweave.session import checkpoint

VNODES = 128
#: Rows that one ordering cell should hold at most, on average.
CELL_ROWS = 50_000


def ring(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(point, shard) in clockwise order. A point depends on its shard's number alone."""
    points = {}
    for shard in range(shards):
        for v in range(vnodes):
            digest = hashlib.sha256(f"shard {shard} node {v}".encode()).digest()
            points.setdefault(int.from_bytes(digest[:8], "big") >> 1, shard)
    return sorted(points.items())


def place(points: list[tuple[int, int]], counts: dict[int, int], shards: int) -> list[tuple]:
    """(arc, first rank, end rank, shard, first slot) for all rows counted by arc.

    Own rows come first, in ring order; what is left over then walks clockwise.
    """
    n = sum(counts.values())
    room = [n // shards + (s < n % shards) for s in range(shards)]
    used = [0] * shards
    parts: list[tuple] = []

    def take(arc: int, at: int, end: int, shard: int) -> int:
        k = min(end - at, room[shard] - used[shard])
        if k:
            parts.append((arc, at, at + k, shard, used[shard]))
            used[shard] += k
        return at + k

    left = {}
    for arc, (_, shard) in enumerate(points):
        if count := counts.get(arc, 0):
            at = take(arc, 0, count, shard)
            if at < count:
                left[arc] = at
    for arc, at in left.items():
        step = arc
        while at < counts[arc]:
            step = (step + 1) % len(points)
            at = take(arc, at, counts[arc], points[step][1])
    return parts


def arc_finder(points: list[tuple[int, int]]):
    """Column function: the arc of a position, that is the first point at or after it."""
    marks = [p for p, _ in points]

    @F.pandas_udf("int")
    def arc(h: pd.Series) -> pd.Series:
        at = np.searchsorted(np.asarray(marks, np.int64), h.to_numpy(np.int64))
        return pd.Series((at % len(marks)).astype(np.int32))

    return arc


def shard_rows(
    docs: DataFrame, *, shards: int = 8, vnodes: int = VNODES, cell_rows: int = CELL_ROWS
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row of ``docs``.

    ``size`` is the UTF-8 bytes of the text plus one, ``slot`` a gapless number from 0 within
    the shard.
    """
    spark = docs.sparkSession
    points = ring(shards, vnodes)
    text = F.coalesce("text", F.lit(""))
    place_of = row_key(F.col("doc_id")).bitwiseAND(F.lit((1 << 63) - 1))
    rows = checkpoint(docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        row_key(F.col("doc_id"), F.col("text")).alias("order"),
        arc_finder(points)(place_of).alias("arc")), "ring-rows")
    counts = {r["arc"]: r["n"] for r in  # at most shards * vnodes rows
              rows.groupBy("arc").agg(F.count("*").alias("n")).collect()}
    arcs = spark.createDataFrame(
        [(a, max(1, -(-n // cell_rows))) for a, n in counts.items()], "arc int, n_cells int")
    parts = spark.createDataFrame(
        place(points, counts, shards), "arc int, lo long, hi long, shard int, base long")

    celled = rows.join(F.broadcast(arcs), "arc").withColumn(
        "cell", F.pmod(F.xxhash64("order"), F.col("n_cells")).cast("int"))
    ahead = celled.groupBy("arc", "cell").agg(F.count("*").alias("n")).select(
        "arc", "cell", (F.sum("n").over(Window.partitionBy("arc").orderBy("cell")) - F.col("n"))
        .alias("ahead"))
    ranked = celled.withColumn("at", F.row_number().over(
        Window.partitionBy("arc", "cell").orderBy("order", "doc_id", "text_crc32", "size")) - 1)
    rank = F.col("ahead") + F.col("at")
    return (
        ranked.join(ahead, ["arc", "cell"]).withColumn("rank", rank)
        .join(F.broadcast(parts), "arc")
        .filter((F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")))
        .select("doc_id", "size", "text_crc32", "shard",
                (F.col("base") + F.col("rank") - F.col("lo")).alias("slot"))
    )
