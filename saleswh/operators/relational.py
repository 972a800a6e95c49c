"""Filters, projections, joins, groupings and top-k used by the simple queries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswh.functions import in_order, largest_first


def rows_at_min(df: DataFrame, col: str) -> DataFrame:
    """All rows that hold the smallest value of a column, ties included."""
    return df.filter(F.col(col) == df.agg(F.min(col)).scalar())


def conform(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Rename, reorder and subset columns: {target name: source column}."""
    return df.select(
        *[(F.col(src) if isinstance(src, str) else src).alias(dst) for dst, src in mapping.items()]
    )


def choices(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values of a column."""
    return df.select(col).distinct().orderBy(*in_order(col))


def date_bounds(df: DataFrame, col: str = "order_date") -> DataFrame:
    return df.agg(
        F.to_date(F.min(col)).alias("min_date"), F.to_date(F.max(col)).alias("max_date")
    )


def distinct_dim(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct rows on a column subset; nulls count as equal."""
    return df.select(*cols).distinct()


def count_by(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias(name))


def top_k(df: DataFrame, value: str, key: str, n: int) -> DataFrame:
    """The n rows with the largest value; equal values by key."""
    return df.orderBy(*largest_first(value, key)).limit(n)


def groups_having(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, name: str, more_than: int) -> DataFrame:
    """Parent names that have more than n child rows.

    Child rows are counted per key before the join, so a key that owns a large
    part of them shuffles as one partial count per task.
    """
    counts = child.groupBy(F.col(child_key).alias(parent_key)).agg(F.count("*").alias("_n"))
    return (
        counts.join(parent.select(parent_key, name), parent_key)
        .groupBy(name)
        .agg(F.sum("_n").alias("n"))
        .filter(F.col("n") > more_than)
    )


def mode_value(df: DataFrame, col: str) -> DataFrame:
    """Most frequent non-null value, the smallest one on ties; no row for empty input."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("_n"))
    return counts.orderBy(*largest_first("_n", col)).limit(1).select(col)


def top_group(df: DataFrame, key: str, value: str, total: str = "total") -> DataFrame:
    """The group with the largest sum, and that sum; the smallest key on ties, null keys left out."""
    sums = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum(value).alias(total))
    return sums.orderBy(*largest_first(total, key)).limit(1)


def first_by(df: DataFrame, keys: Sequence[str], cols: Sequence[str], order: str) -> DataFrame:
    """First non-null value of each column per key, by ``order``; the smallest value on ties.

    Rows are first reduced to one per (keys, value set) with a plain minimum, which
    hash-aggregates before the shuffle; only those few rows are compared further.
    """
    reduced = df.groupBy(*keys, *cols).agg(F.min(order).alias("_at"))
    return reduced.groupBy(*keys).agg(
        *[
            F.min_by(c, F.when(F.col(c).isNotNull(), F.struct("_at", c))).alias(c)
            for c in cols
        ]
    )


def previous_period(df: DataFrame, period: str, value: str) -> DataFrame:
    """The latest period with its value and the value of the period before; one row per result.

    Works on the two newest periods only, found by a distributed top-2.
    """
    two = df.orderBy(F.col(period).desc()).limit(2)
    newest_first = two.agg(
        F.count("*").alias("_n"),
        F.max(period).alias(period),
        F.max_by(value, period).alias(value),
        F.min_by(value, period).alias("_before"),
    )
    return newest_first.filter(F.col("_n") > 0).select(
        period, value, F.when(F.col("_n") > 1, F.col("_before")).alias(f"previous_{value}")
    )
