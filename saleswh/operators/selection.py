"""Exact values at ranks of a sorted column without sorting it.

A mergeable quantile sketch brackets the wanted ranks between two values. When few values lie in the bracket, one aggregation
counts them and the rows below. Otherwise it counts the rows of each of ``slices`` equal ranges of the bracket, with
their smallest and largest value, and the slice that holds the ranks is the next bracket, until it holds one value or
few. What is shuffled is a row per task and range; no row of the column itself is sorted or written, and a value that
a third of all rows share is one count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

SLICES = 1024
#: Distinct values of a bracket that may be counted one by one.
FEW = 20_000
#: The sketch's error is about 1/ACCURACY of the rows.
ACCURACY = 10_000
HUGE = 8e307


def bracket(value: str | Column, fraction: float, accuracy: int = ACCURACY) -> tuple[Column, Column]:
    """Aggregates for two values that most likely enclose the rank at ``fraction``; select_ranks repairs a miss."""
    near = [max(0.0, fraction - 2 / accuracy), min(1.0, fraction + 2 / accuracy)]
    found = F.percentile_approx(value, near, accuracy)
    return found[0], found[1]


def select_ranks(
    values: DataFrame, ranks: Sequence[int], low, high, slices: int = SLICES, few: int = FEW
) -> list[tuple[object, int]]:
    """For each 0-based rank of the one numeric column: (value, number of rows with a smaller value).

    ``low`` and ``high``: a guess of values that enclose all ranks, such as the column's smallest and largest; a wrong guess
    costs another pass. Nulls are not counted; the ranks must lie within the remaining rows and, for speed, near one another.
    """
    (name,) = values.columns
    v = F.col(f"`{name}`")
    rows = values.filter(v.isNotNull())
    found: dict[int, tuple[object, int]] = {}
    while left := sorted(set(ranks) - set(found)):
        counts = _values(rows, v, low, high, few) or _slices(rows, v, low, high, slices)
        before = 0
        bounds = None
        for c in counts:
            mine = [r for r in left if before <= r < before + c.n]
            if mine and c.least == c.most:
                found.update({r: (c.least, before) for r in mine})
            elif mine and bounds is None:
                bounds = c.least, c.most
            before += c.n
        if left[-1] >= before:
            raise ValueError(f"rank {left[-1]} is beyond the {before} rows")
        # the range that holds the first rank still open; the others follow in later rounds
        low, high = bounds or (low, high)
    return [found[r] for r in ranks]


def _values(rows: DataFrame, v: Column, low, high, few: int) -> list[Row]:
    """n, least, most of the rows below, of each distinct value from low to high, and of the rows above; [] if too many."""
    part = F.when(v < F.lit(low), -1).when(v > F.lit(high), 1).otherwise(0)
    by = rows.groupBy(part.alias("part"), F.when(v.between(F.lit(low), F.lit(high)), v).alias("v"))
    counted = by.agg(F.count("*").alias("n"), F.min(v).alias("least"), F.max(v).alias("most")).limit(few + 3).collect()
    return sorted(counted, key=lambda c: (c.part, c.least)) if len(counted) <= few + 2 else []


def _slices(rows: DataFrame, v: Column, low, high, slices: int) -> list[Row]:
    """n, least, most of the rows below, of each slice from low to high that has rows, and of the rows above."""
    def number(c: Column) -> Column:
        # infinite and very large values share an end, so that differences stay finite
        return F.least(F.greatest(c.cast("double"), F.lit(-HUGE)), F.lit(HUGE))

    first, last = number(F.lit(low)), number(F.lit(high))
    # a monotone function of the value that sends low to the first slice and high to the last one
    place = F.floor((number(v) - first) / F.greatest(last - first, F.lit(5e-324)) * slices)
    place = F.least(F.greatest(place, F.lit(0)), F.lit(slices - 1))
    place = F.when(v == F.lit(low), 0).when(v == F.lit(high), slices - 1).otherwise(place.cast("int"))
    part = F.when(v < F.lit(low), -1).when(v > F.lit(high), slices).otherwise(place)
    counted = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min(v).alias("least"), F.max(v).alias("most"))
    return sorted(counted.collect(), key=lambda c: c.part)  # at most slices + 2 rows
