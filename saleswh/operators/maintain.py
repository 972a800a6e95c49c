"""Table maintenance as DataFrame rewrites: columns, updates, deletes, inserts, replication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_column(df: DataFrame, name: str, dtype: str) -> DataFrame:
    """A new nullable column."""
    return df.withColumn(name, F.lit(None).cast(dtype))


def update_where(df: DataFrame, cond: Column, values: Mapping[str, Column | object]) -> DataFrame:
    """Set columns where the condition is true; types stay those of the table."""
    types = dict(df.dtypes)
    as_col = {c: v if isinstance(v, Column) else F.lit(v) for c, v in values.items()}
    return df.withColumns(
        {c: F.when(cond, v.cast(types[c])).otherwise(F.col(c)) for c, v in as_col.items()}
    )


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """Drop rows where the condition is true; rows where it is null stay."""
    return df.filter(~F.coalesce(cond, F.lit(False)))


def append_rows(df: DataFrame, rows: Sequence[tuple], cols: Sequence[str] | None = None) -> DataFrame:
    """Insert literal rows; columns not named become null."""
    names = list(cols or df.columns)
    schema = type(df.schema)([df.schema[c] for c in names])
    return df.unionByName(df.sparkSession.createDataFrame(list(rows), schema), allowMissingColumns=True)


def append_select(dst: DataFrame, src: DataFrame, cond: Column, values: Mapping[str, Column | object]) -> DataFrame:
    """Insert rows selected from another table: {column of dst: source column or constant}."""
    types = dict(dst.dtypes)
    picked = src.filter(cond).select(
        *[(v if isinstance(v, Column) else F.lit(v)).cast(types[c]).alias(c) for c, v in values.items()]
    )
    return append(dst, picked)


def append(a: DataFrame, b: DataFrame) -> DataFrame:
    """All rows of both, matched by column name; columns missing in b become null, unknown ones are an error."""
    if unknown := [c for c in b.columns if c not in a.columns]:
        raise ValueError(f"columns that the target does not have: {unknown}")
    return a.unionByName(b, allowMissingColumns=True).select(*a.columns)


def apply_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Fill nulls of existing columns and add missing columns."""
    have = set(df.columns)
    return df.withColumns(
        {c: F.coalesce(F.col(c), v) if c in have else v for c, v in defaults.items()}
    )


def replicate(df: DataFrame, n: int, block: int = 100) -> DataFrame:
    """Every row exactly n times.

    Copies are made inside the tasks, so nothing is shuffled. Beyond ``block``
    copies per row the rows are first spread evenly as numbered blocks, so a small
    file read by one task is still expanded by many.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    if n == 1:
        return df
    if n <= block:
        copies = F.explode(F.sequence(F.lit(1), F.lit(n)))
        return df.withColumn("_copy", copies).drop("_copy")
    blocks = -(-n // block)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).repartition(tasks)
    size = F.least(F.lit(block), F.lit(n) - F.col("_block") * block)
    return spread.withColumn("_copy", F.explode(F.sequence(F.lit(1), size))).drop("_block", "_copy")


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count("*").alias(name))
