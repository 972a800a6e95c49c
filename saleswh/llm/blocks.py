"""Comparing the members of groups in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_blocks(rows: DataFrame, group: str, member: str, most: int) -> DataFrame:
    """rows sorted by (group, block), with side 0 or 1; any two members of a group meet in one block at least.

    A group of up to ``most`` rows is one block, all of side 0. A larger one is dealt into k parts by the member's hash and
    has a block for each two parts (side 0 and 1) and for each part alone (side 0): k copies of a row.
    """
    sizes = rows.groupBy(group).agg(F.ceil(F.count("*") / most).cast("int").alias("parts_n"))
    split = sizes.filter("parts_n > 1")
    part = F.pmod(F.xxhash64(member), F.col("parts_n")).cast("int")
    dealt = rows.join(split, group, "left").withColumn("parts_n", F.coalesce("parts_n", F.lit(1))).withColumn("part", part)
    others = F.transform(
        F.sequence(F.lit(0), F.col("parts_n") - 1),
        lambda o: F.struct(
            (F.least(o, F.col("part")) * F.col("parts_n") + F.greatest(o, F.col("part"))).alias("block"),
            (F.col("part") > o).cast("int").alias("side"),
        ),
    )
    spread = dealt.select(*rows.columns, F.explode(others).alias("at")).select(*rows.columns, "at.block", "at.side")
    return spread.repartition(group, "block").sortWithinPartitions(group, "block")


def by_group(
    keys: list[str], each: Callable[[pa.Table], Iterator[pa.RecordBatch]]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for mapInArrow over rows sorted by keys that calls ``each`` with one group's rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if held:
                last, here = held[-1], table
                new = any(last.column(k)[last.num_rows - 1] != here.column(k)[0] for k in keys)
                if new:
                    yield from each(pa.concat_tables(held))
                    held = []
            change = np.zeros(table.num_rows - 1, bool)
            for k in keys:
                values = table.column(k).to_numpy()
                change |= values[1:] != values[:-1]
            cuts = [0, *(np.flatnonzero(change) + 1), table.num_rows]
            for start, end in zip(cuts[:-1], cuts[1:]):
                held.append(table.slice(start, end - start))
                if end < table.num_rows:
                    yield from each(pa.concat_tables(held))
                    held = []
        if held:
            yield from each(pa.concat_tables(held))

    return run
