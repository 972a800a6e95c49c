"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saleswh.llm.staging import settle


def _up(edges: DataFrame) -> DataFrame:
    """Distinct edges with u > v, loops left out."""
    both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return both.filter(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node of edges (a, b).

    Each step replaces a node's edges by edges to its smallest neighbour. Minima are combined
    before the shuffle and the join back can be split, so a node with very many edges is no
    bottleneck. A settled table ends each step; the steps grow with the logarithm of the longest path.
    """
    now = settle(_up(edges.toDF("u", "v")), "edges")
    while True:
        sym = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sym.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _up(sym.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = settle(_up(moved.unionAll(least.toDF("u", "v"))), "edges")
        # stars that share no node are final
        inner = now.join(now.select(F.col("u").alias("v")).distinct(), "v", "left_semi")
        if inner.isEmpty() and now.groupBy("u").count().filter("count > 1").isEmpty():
            break
    return now.unionAll(now.select(F.col("v").alias("u"), "v")).distinct().toDF("node", "component")
