"""Mixing sources to target weights by Pareto order sampling.

A source's target is its weight's share of all words, at most ``MOST_COPIES`` times its own size;
what is cut off goes to the other sources by weight. Within a source a document of k
significant bits in its size is wanted ``min(MOST_COPIES, c * k)`` times, with c such that the
expected words meet the target: long documents get somewhat more copies than short ones.
The whole part of that number are certain copies. The fraction p is an inclusion probability:
documents are ranked by the random odds u / (1 - u) over the inclusion odds p / (1 - p)
and taken in that order until the words still wanted are reached, so the sample's
size in words is fixed to within half a document while the chances stay unequal.

Everything is counted on aggregates: sizes per (source, bits), and a histogram of the
ranks per source that finds the bin with the cut. Only the documents of that one bin are put in
order, so a source with a third of all rows is not sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleswh.llm.registry import query, table
from saleswh.storage import stage

WORDS = r"[^\x20\x09-\x0D]+"
MOST_COPIES = 3
BINS = 4096


def _filled(most: Column, weight: Column, total: Column, over: Window, tie: Column) -> Column:
    """Candidates for the level c with sum(min(most, c * weight)) = total; the largest is c.

    Rows are filled in the order of most / weight. If all rows before a row are at their limits, c is
    (total - sum of these limits) / (sum of the weights left). The first row that this level does not
    fill is the right one, and the levels of rows behind it are no higher.
    """
    order = over.orderBy((most / weight).asc(), tie)
    before = F.coalesce(F.sum(most).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum(weight).over(over) - F.coalesce(
        F.sum(weight).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    level = (total - before) / left
    return F.when(level * weight <= most, level)


def source_targets(sizes: DataFrame, most_copies: int = MOST_COPIES) -> DataFrame:
    """source, source_size, target: sizes holds source and size per row.

    Sources are ordered by code point, null last, and weigh 1, 2, 3, 1, 2, 3, ...
    The windows run over one row per source.
    """
    every = Window.partitionBy()
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(every.orderBy(F.col("source").asc_nulls_last()))
    weighed = by_source.withColumn("weight", (place - 1) % 3 + 1).withColumn("place", place)
    # a source without words takes nothing and must not count among the weights
    full = weighed.filter("source_size > 0")
    limit = F.lit(most_copies) * F.col("source_size")
    level = _filled(limit, F.col("weight"), F.sum("source_size").over(every), every, F.col("place"))
    levels = full.withColumn("level", level).withColumn("level", F.max("level").over(every))
    target = F.least(limit.cast("double"), F.col("level") * F.col("weight"))
    empty = weighed.filter("source_size = 0").select("source", "source_size", F.lit(0.0).alias("target"))
    return levels.select("source", "source_size", target.alias("target")).unionAll(empty)


def _uniform(key: Column, seed: int) -> Column:
    """A number strictly between 0 and 1 that depends on key and seed only."""
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)


def pareto_mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 1,
    most_copies: int = MOST_COPIES,
) -> DataFrame:
    """One row per row of docs: doc_id, size, source_size, target, taken, copies.

    size: words of the text (null: 0); taken = copies * size. Documents without words are
    taken 0 times. Draws depend on the key and the seed only and ties are broken by size, so reruns agree; rows of one key share
    their draw. Other columns of docs are not read. No rows give no rows.
    """
    rows = stage(
        docs.select(
            F.col(f"`{key}`").alias("doc_id"),
            F.col(f"`{source}`").cast("string").alias("source"),
            F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORDS)), F.lit(0)).cast("bigint").alias("size"),
        ),
        "sizes",
    ).withColumn("bits", F.when(F.col("size") > 0, F.length(F.bin("size"))).otherwise(0))

    targets = stage(source_targets(rows, most_copies), "targets")
    # c per source: sizes meet the target when a document of k bits has min(most_copies, c * k) copies
    same = Window.partitionBy("source")
    classes = (
        rows.filter("size > 0").groupBy("source", "bits").agg(F.sum("size").alias("class_size"))
        .join(targets.select(F.col("source").alias("of"), "target"), F.col("source").eqNullSafe(F.col("of")))
        .select("source", "target", "bits", "class_size")
    )
    level = _filled(
        F.lit(float(most_copies)) * F.col("class_size"), F.col("bits") * F.col("class_size"),
        F.col("target"), same, F.col("bits"),
    )
    levels = classes.withColumn("level", level).groupBy("source").agg(F.max("level").alias("level"))
    per_source = stage(
        targets.withColumnRenamed("source", "of")
        .join(levels, F.col("source").eqNullSafe(F.col("of")), "left")
        .select("of", "source_size", "target", "level"),
        "levels",
    )

    # a source whose target is all it may give has no level
    wanted = F.when(F.col("size") == 0, 0.0).otherwise(
        F.least(F.lit(float(most_copies)), F.coalesce(F.col("level"), F.lit(float(most_copies))) * F.col("bits"))
    )
    u, p = _uniform(F.col("doc_id"), seed), F.col("p")
    drawn = (
        rows.join(per_source, F.col("source").eqNullSafe(F.col("of")))
        .withColumn("wanted", wanted)
        .withColumn("whole", F.floor("wanted"))
        .withColumn("p", F.col("wanted") - F.col("whole"))
        .withColumn("rank", F.when(p > 0, (u / (1 - u)) / (p / (1 - p))))
        # order-preserving bins of the ranks
        .withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * BINS))
    )
    left = F.col("target") - F.col("sure")
    sure = drawn.groupBy("of").agg(F.sum(F.col("whole") * F.col("size")).alias("sure"))
    bins = drawn.filter("rank is not null").groupBy("of", "bin").agg(F.sum("size").alias("bin_size"))
    up_to = Window.partitionBy("of").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        bins.withColumn("before", F.coalesce(F.sum("bin_size").over(up_to), F.lit(0)))
        .join(sure.withColumnRenamed("of", "s"), F.col("of").eqNullSafe(F.col("s")))
        .join(per_source.select(F.col("of").alias("t"), "target"), F.col("of").eqNullSafe(F.col("t")))
        .withColumn("left", left)
        .filter(F.col("before") < F.col("left"))
        .groupBy("of")
        .agg(F.max_by(F.struct("bin", "before", "left"), "bin").alias("cut"))
    )
    cuts = stage(cuts.select(F.col("of").alias("cut_of"), "cut.*").withColumnRenamed("bin", "cut_bin"), "cuts")

    marked = drawn.join(cuts, F.col("of").eqNullSafe(F.col("cut_of")), "left")
    inside = F.col("bin") == F.col("cut_bin")
    # rows that agree in all three are the same to the result
    ordered = Window.partitionBy("of").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    # in the bin of the cut a document goes in while its middle lies before the end
    middle = F.col("before") + F.coalesce(F.sum("size").over(ordered), F.lit(0)) + F.col("size") / 2
    at_cut = marked.filter(inside).withColumn("more", (middle <= F.col("left")).cast("int"))
    elsewhere = marked.filter(~F.coalesce(inside, F.lit(False))).withColumn(
        "more", F.coalesce((F.col("bin") < F.col("cut_bin")).cast("int"), F.lit(0))
    )
    copies = (F.col("whole") + F.col("more")).cast("bigint")
    return at_cut.unionByName(elsewhere).select(
        "doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies")
    )


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM s),
v AS (SELECT *, (place - 1) % 3 + 1 AS weight, 3 * source_size AS most FROM w),
f AS (
  SELECT *, (sum(source_size) OVER ()
      - coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER ()
      - coalesce(sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS c
  FROM v WHERE source_size > 0),
t AS (
  SELECT source, source_size, least(most::DOUBLE, max(CASE WHEN c * weight <= most THEN c END) OVER () * weight) AS target
  FROM f UNION ALL SELECT source, source_size, 0.0 FROM v WHERE source_size = 0),
b AS (SELECT *, CASE WHEN size > 0 THEN length(bin(size)) ELSE 0 END AS bits FROM d),
k AS (
  SELECT b.source, target, bits, 3.0::DOUBLE * sum(size)::DOUBLE AS most, (bits * sum(size))::DOUBLE AS weight
  FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source WHERE size > 0 GROUP BY b.source, target, bits),
kc AS (
  SELECT *, (target
      - coalesce(sum(most) OVER (PARTITION BY source ORDER BY most / weight, bits ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / (sum(weight) OVER (PARTITION BY source)
      - coalesce(sum(weight) OVER (PARTITION BY source ORDER BY most / weight, bits ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS c
  FROM k),
lv AS (SELECT source, max(CASE WHEN c * weight <= most THEN c END) AS level FROM kc GROUP BY source),
x AS (
  SELECT doc_id, b.source, size, source_size, target,
    CASE WHEN size = 0 THEN 0.0::DOUBLE ELSE least(3.0::DOUBLE, coalesce(level, 3.0::DOUBLE) * bits) END AS wanted,
    (('0x' || substr(md5('1:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE + 0.5::DOUBLE) / 281474976710656.0::DOUBLE AS u
  FROM b JOIN t ON b.source IS NOT DISTINCT FROM t.source LEFT JOIN lv ON b.source IS NOT DISTINCT FROM lv.source),
y AS (SELECT *, floor(wanted) AS whole, wanted - floor(wanted) AS p FROM x),
r AS (
  SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS rank,
    target - sum(whole * size) OVER (PARTITION BY source) AS remaining FROM y),
q AS (
  SELECT *, coalesce(sum(CASE WHEN rank IS NOT NULL THEN size END) OVER (
    PARTITION BY source ORDER BY rank NULLS LAST, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 AS middle
  FROM r),
z AS (SELECT *, (whole + CASE WHEN rank IS NOT NULL AND middle <= remaining THEN 1 ELSE 0 END)::BIGINT AS copies FROM q)
SELECT doc_id, size, source_size, target, (copies * size)::BIGINT AS taken, copies FROM z
"""


@query(OP4_SQL)
def op4_pareto_mix(spark, sf_dir):
    return pareto_mix(table(spark, sf_dir, "documents"))
