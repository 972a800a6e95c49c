"""Per-key timelines that stay balanced when one key holds a large part of all rows.

A window over one key runs in one task. Keys with more than ``hot_rows`` rows are
therefore cut into time slices (column ``_slice``, null for all other keys): each
slice is a group of its own, and a small per-slice summary hands the last known
value on from slice to slice. All rows take the same single shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT_ROWS = 5_000_000
# slices of a hot key, and of an hour that is still too full
SLICE_UNITS = ("hour", "second")


@dataclass(frozen=True)
class HotSpots:
    """Keys with more than ``hot_rows`` rows, and their time slices that are as full."""

    key: str
    keys: DataFrame
    slices: DataFrame
    units: tuple[str, str]


def hot_spots(
    source: DataFrame, key: str, ts: str, hot_rows: int = HOT_ROWS, units: tuple[str, str] = SLICE_UNITS
) -> HotSpots:
    """Count the source's rows per key, and per slice for the hot keys; reads these two columns only.

    Each list holds at most rows / hot_rows entries, so both are small enough to broadcast.
    ``source`` should be the plain input of a job, not something costly made from it.
    Business keys are not null, so null keys are never split.
    """
    many = F.col("_n") > hot_rows
    keys = source.groupBy(key).agg(F.count("*").alias("_n")).filter(many).select(key)
    slices = (
        source.join(F.broadcast(keys), key, "left_semi")
        .groupBy(key, F.date_trunc(units[0], F.col(ts)).alias("_coarse"))
        .agg(F.count("*").alias("_n"))
        .filter(many)
        .select(key, "_coarse")
    )
    return HotSpots(key, keys, slices, units)


def slice_hot(df: DataFrame, key: str, ts: str, spots: HotSpots) -> DataFrame:
    """Add ``_slice``: the start of the time slice a row falls in if its key is hot, else null.

    Slices are of the first unit; a full one is cut by the second.
    """
    coarse, fine = (F.date_trunc(unit, F.col(ts)) for unit in spots.units)
    keys = spots.keys.select(F.col(spots.key).alias(key), F.lit(True).alias("_hot"))
    full = spots.slices.select(F.col(spots.key).alias(key), "_coarse", F.lit(True).alias("_full"))
    marked = df.join(F.broadcast(keys), key, "left").withColumn("_coarse", F.when(F.col("_hot"), coarse))
    return marked.join(F.broadcast(full), [key, "_coarse"], "left").select(
        *df.columns, F.when(F.col("_full"), fine).otherwise(F.col("_coarse")).alias("_slice")
    )


def carry(
    sliced: DataFrame,
    key: str,
    order: Sequence[str],
    values: Mapping[str, str],
    *,
    inclusive: bool = False,
    backward: bool = False,
) -> DataFrame:
    """Add the nearest earlier non-null value of columns, per key in the given order.

    sliced: rows with ``_slice`` made from the first order column (see slice_hot).
    values: {new column: source column}. inclusive: the row's own value counts.
    backward: the nearest later value instead. Rows of one key that are equal in
    ``order`` must not set the same column to different values.
    """
    group = [key, "_slice"]
    within = sliced.select(
        "*", *_nearest(values, {c: c for c in values}, group, order, inclusive, backward)
    )

    # what each slice of a hot key knows by its end, and from it what the next one starts with
    pick = F.min_by if backward else F.max_by
    known = {new: F.when(F.col(src).isNotNull(), F.struct(*order)) for new, src in values.items()}
    ends = (
        sliced.filter(F.col("_slice").isNotNull())
        .groupBy(*group)
        .agg(*[pick(src, known[new]).alias(f"_end_{new}") for new, src in values.items()])
    )
    at_end = {new: f"_end_{new}" for new in values}
    handed = ends.select(
        *group, *_nearest(at_end, {c: f"_from_{c}" for c in values}, [key], ["_slice"], False, backward)
    )
    return within.join(handed, group, "left").select(
        *sliced.columns, *[F.coalesce(new, f"_from_{new}").alias(new) for new in values]
    )


def _nearest(
    sources: Mapping[str, str],
    names: Mapping[str, str],
    by: Sequence[str],
    order: Sequence[str],
    inclusive: bool,
    backward: bool,
) -> list[Column]:
    w = (
        Window.partitionBy(*by)
        .orderBy(*[F.col(c).desc() if backward else F.col(c).asc() for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    )
    return [F.last(src, ignorenulls=True).over(w).alias(names[new]) for new, src in sources.items()]
