"""Numbering rows in a global order without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleswh.functions import in_order
from saleswh.storage import stage

# monotonically_increasing_id keeps the row's place in its partition in the low 33 bits
_PLACE_BITS = 33
_PLACE_MASK = (1 << _PLACE_BITS) - 1


def _part() -> Column:
    """The sort partition a staged row came from."""
    return F.shiftright("_slot", _PLACE_BITS)


def number_rows(
    df: DataFrame,
    order: Sequence[str | Column],
    name: str,
    start: int | Column = 1,
) -> DataFrame:
    """Add dense numbers start, start+1, ... in the given order, which must tell all rows apart.

    A row's number is its place in its sort partition plus the sizes of the
    partitions before.
    """
    staged, before = _sorted_once(df, order, F.count("*"))
    first = start if isinstance(start, Column) else F.lit(start)
    place = F.col("_slot").bitwiseAND(F.lit(_PLACE_MASK))
    return staged.select(*df.columns, (before + place + first).cast("bigint").alias(name))


def running_total(df: DataFrame, order: Sequence[str | Column], value: str, name: str) -> DataFrame:
    """Add the sum of a whole-number column over all rows up to and with this one, in the given order."""
    staged, before = _sorted_once(df, order, F.sum(value))
    within = Window.partitionBy(_part()).orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    return staged.select(*df.columns, (before + F.sum(value).over(within)).cast("bigint").alias(name))


def _sorted_once(df: DataFrame, order, measure: Column) -> tuple[DataFrame, Column]:
    """Range-sort and write the rows once; also the measure of all partitions before a row's own.

    Only one number per sort partition comes to the driver, however large the data;
    it goes back as a constant array, so using the numbered rows needs no join.
    """
    ordered = df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id())
    staged = stage(ordered, "numbered")
    sizes = {r["part"]: r["size"] for r in staged.groupBy(_part().alias("part")).agg(measure.alias("size")).collect()}
    before, total = [], 0
    for part in range(max(sizes, default=0) + 1):
        before.append(str(total))
        total += sizes.get(part, 0)
    starts = F.split(F.lit(",".join(before)), ",").cast("array<bigint>")
    return staged, F.get(starts, _part().cast("int"))


def next_key(table: DataFrame, name: str) -> Column:
    """max(name) + 1 of a table, or 1 when it is empty."""
    return table.agg(F.coalesce(F.max(name) + 1, F.lit(1)).alias("next_key")).scalar()


def assign_key(
    df: DataFrame, natural_key: Sequence[str], name: str, after: DataFrame | None = None
) -> DataFrame:
    """Surrogate key in natural-key order, dense from 1.

    ``after``: the table the rows will be added to; numbering goes on from its highest key.
    """
    start = next_key(after, name) if after is not None else 1
    numbered = number_rows(df, in_order(*natural_key), name, start)
    return numbered.select(name, *df.columns)
