"""Constraint checks. Each returns the violations; no rows means the constraint holds."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def check_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Number of nulls for each column that has any; one pass over the data."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], list(cols), "column_name", "nulls").filter(F.col("nulls") > 0)


def check_fk(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, with their row counts; null keys are allowed.

    Children are counted per key first, so a frequent key joins as one row.
    """
    used = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_key).alias(key))
    return used.join(known, key, "left_anti")


def check_max_len(df: DataFrame, col: str, n: int) -> DataFrame:
    """Rows whose text is longer than n characters."""
    return df.filter(F.length(col) > n)


@dataclass(frozen=True)
class Rules:
    """Row rules of a table: columns never null, longest texts, smallest and largest values."""

    not_null: Sequence[str] = ()
    max_len: Mapping[str, int] = field(default_factory=dict)
    least: Mapping[str, object] = field(default_factory=dict)
    most: Mapping[str, object] = field(default_factory=dict)

    def broken(self) -> dict:
        """Conditions that no row may meet, by name; a null breaks ``not_null`` only."""
        return {
            **{f"{c}:null": F.col(c).isNull() for c in self.not_null},
            **{f"{c}:length>{n}": F.length(c) > n for c, n in self.max_len.items()},
            **{f"{c}:value<{n}": F.col(c) < n for c, n in self.least.items()},
            **{f"{c}:value>{n}": F.col(c) > n for c, n in self.most.items()},
        }


def observe(df: DataFrame, rules: Rules) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """df, and a function that gives the number of rows that break each rule once df has been written or counted.

    The counts come with that action: the rows are not read again. Unique keys and references need a shuffle and
    are checked by check_unique and check_fk.
    """
    broken = rules.broken()
    seen = Observation()
    observed = df.observe(seen, F.count("*").alias("rows"), *[F.count_if(c).alias(name) for name, c in broken.items()])

    def violations() -> dict[str, int]:
        return {name: n for name in broken if (n := seen.get[name])}

    return observed, violations
