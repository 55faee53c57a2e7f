"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from labweave.session import checkpoint
from labweave.sources.config import broadcast_if_small, fits_broadcast

HOT_ROWS = 2_000_000


def _same(keys: Sequence[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys])


def join_groups(
    left: DataFrame, groups: DataFrame, keys: Sequence[str], *, spread: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left join of rows with a table that has one row per group and the group's size ``n``.

    The groups are landed once. If they fit the broadcast bound the rows are not shuffled;
    beyond it the join is split where a group is large.
    """
    keys = list(keys)
    groups = checkpoint(groups, "groups")
    if not fits_broadcast(groups):
        return split_hot_join(
            left, groups.drop("n"), keys, groups.select(*keys, "n"), spread=spread,
            hot_rows=hot_rows)
    renamed = groups.drop("n").withColumnsRenamed({k: f"_r_{k}" for k in keys})
    return left.join(F.broadcast(renamed), _same(keys, "_r_"), "left").drop(
        *[f"_r_{k}" for k in keys])


def split_hot_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    counts: DataFrame,
    *,
    how: str = "left",
    spread: Sequence[str],
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Equi-join on null-safe ``keys`` where ``right`` has one row per key.

    ``counts`` has the keys and ``n``, the rows ``left`` has for each. A key above
    ``hot_rows`` is cut into ``ceil(n / hot_rows)`` parts by a hash of the ``spread`` columns
    and its right row is repeated once per part, so no task gets more than about
    ``hot_rows`` rows of one key. The hot list has at most rows / hot_rows entries; it is landed
    and broadcast only if it measures small.
    """
    keys = list(keys)
    hot = broadcast_if_small(checkpoint(counts.filter(F.col("n") > hot_rows).select(
        *[F.col(k).alias(f"_h_{k}") for k in keys],
        F.ceil(F.col("n") / F.lit(hot_rows)).cast("int").alias("_parts"),
    ), "hot-keys"))

    def with_parts(df: DataFrame) -> DataFrame:
        out = df.join(hot, _same(keys, "_h_"), "left")
        return out.withColumn("_parts", F.coalesce("_parts", F.lit(1))).drop(
            *[f"_h_{k}" for k in keys]
        )

    salted = with_parts(left).withColumn(
        "_salt", F.pmod(F.xxhash64(*spread), F.col("_parts").cast("long")).cast("int")
    ).drop("_parts")
    copies = with_parts(right).withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    ).drop("_parts")
    copies = copies.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys],
        *[c for c in copies.columns if c not in keys],
    )
    on = _same(keys, "_r_") & (F.col("_salt") == F.col("_part"))
    return salted.join(copies, on, how).drop("_salt", "_part", *[f"_r_{k}" for k in keys])
