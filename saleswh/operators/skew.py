"""Lookups of one row per key that stay balanced when one key holds a large part of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot from 1/HOT_SHARE of all rows on, so there are at most HOT_SHARE hot keys.
HOT_SHARE = 1000
#: Parts that the rows of a hot key are dealt into.
SALTS = 64


def hot_keys(rows: DataFrame, keys: Sequence[str], share: int = HOT_SHARE) -> DataFrame:
    """Keys with at least 1/share of the rows (and two): at most ``share`` of them, so the list can be broadcast.

    Rows are counted per key, which combines in the tasks before the shuffle; only the key columns are read.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_n"))
    total = rows.agg(F.count("*").alias("_total")).scalar()
    return counts.filter((F.col("_n") > 1) & (F.col("_n") * share >= total)).select(*keys)


def likely_hot(rows: DataFrame, columns: Sequence[str], share: int = HOT_SHARE) -> dict[str, DataFrame | None]:
    """Values of each column that a mergeable frequent-items summary puts at 1/share of the rows or more.

    One pass over all columns and at most ``share`` values each; None when there are none. A value that is missed or listed for nothing costs balance,
    never rows, so the summary's estimates need no second count.
    """
    tops = [F.expr(f"approx_top_k(`{c}`, {share}, {16 * share})").alias(c) for c in columns]
    found = rows.agg(F.count("*").alias("_total"), *tops).collect()[0]
    out = {}
    for c in columns:
        hot = [(e["item"],) for e in found[c] or () if e["item"] is not None and e["count"] > 1 and e["count"] * share >= found["_total"]]
        out[c] = rows.sparkSession.createDataFrame(hot, rows.select(c).schema) if hot else None
    return out


def lookup_join(
    rows: DataFrame,
    single: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    hot: DataFrame | None = None,
    salts: int = SALTS,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """rows with the columns of ``single``, which has at most one row per key; null keys find nothing.

    The rows of a hot key are dealt by a hash of the row into ``salts`` parts, and its single row goes to each of them.
    ``hot``: the hot keys when the caller has them (see hot_keys). ``spread_by``: columns that tell rows of one key apart, all by
    default; rows equal in them stay in one part.
    """
    keys = list(keys)
    hot = hot if hot is not None else hot_keys(rows, keys)
    flags = F.broadcast(hot.select(*keys, F.lit(True).alias("_hot")))
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in spread_by or rows.columns]), F.lit(salts))
    dealt = rows.join(flags, keys, "left").select(*rows.columns, F.when(F.col("_hot"), part).otherwise(F.lit(0)).cast("int").alias("_salt"))
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copies = single.join(flags, keys, "left").select(*single.columns, F.explode(every).alias("_salt"))
    added = [c for c in single.columns if c not in keys]
    return dealt.join(copies, [*keys, "_salt"], how).select(*rows.columns, *added)
