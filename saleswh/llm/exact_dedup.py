"""Exact dedup with a heavy-hitter split.

Texts are equal when their digests are: SHA-256 of the text with each run of white space
replaced by one blank. A Misra-Gries summary (the mergeable frequent-items sketch behind
Spark's ``approx_top_k``) names candidates for frequent digests. Their exact counts are
taken next, and those that hold at least 1/``heavy`` of all rows are the verified
winners: at most ``heavy`` digests, so they can be broadcast, and their rows are settled
without a shuffle. All other digests are shuffled in the ordinary way; none of them owns
more than about 1/``heavy`` of the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleswh.llm.registry import query, table
from saleswh.storage import stage

#: Runs of blank, tab, line feed, vertical tab, form feed and carriage return.
WHITE = r"[\x20\x09-\x0D]+"
#: A digest is heavy from 1/HEAVY of all rows on: at most HEAVY digests are broadcast.
HEAVY = 1000
#: Counters of the Misra-Gries summary.
COUNTERS = 16 * HEAVY


def normalised(text):
    """Text with each run of white space as one blank; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def heavy_digests(rows: DataFrame, heavy: int = HEAVY, counters: int = COUNTERS) -> DataFrame:
    """Digests with at least 1/heavy (and 2) of the rows: digest, size, keep (the first row).

    The summary only proposes; sizes are counted exactly, so a false candidate cannot win.
    """
    found = rows.agg(F.expr(f"approx_top_k(digest, {heavy}, {max(heavy, counters)})").alias("top"))
    candidates = found.select(F.explode("top.item").alias("digest"))
    least = rows.agg(F.greatest(F.lit(2), F.ceil(F.count("*") / heavy))).scalar()
    exact = (
        rows.join(F.broadcast(candidates), "digest", "left_semi")
        .groupBy("digest")
        .agg(F.count("*").alias("size"), F.min("place").alias("keep"))
    )
    return stage(exact.filter(F.col("size") >= least), "heavy")


def exact_dedup(
    docs: DataFrame, key: str = "doc_id", text: str = "text", heavy: int = HEAVY, counters: int = COUNTERS
) -> DataFrame:
    """One row per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the smallest key stays; null keys come last, and of rows that repeat
    a key and a text just one stays. Null texts equal empty ones. Columns other than key and
    text are not read, whatever their names. No rows give no rows.
    """
    digests = docs.select(
        F.col(f"`{key}`").alias("doc_id"), F.sha2(normalised(F.col(f"`{text}`")), 256).alias("digest")
    ).withColumn("row", F.monotonically_increasing_id())
    # written once: the row numbers below must not change when a task runs again
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row").alias("place")
    rows = stage(digests, "digests").select("digest", place)
    winners = F.broadcast(heavy_digests(rows, heavy, counters))
    settled = rows.join(winners, "digest")
    same = Window.partitionBy("digest")
    rest = rows.join(winners, "digest", "left_anti").select(
        "digest", "place", F.count("*").over(same).alias("size"), F.min("place").over(same).alias("keep")
    )
    return settled.select(*rest.columns).unionAll(rest).select(
        F.col("place.doc_id").alias("doc_id"),
        F.col("keep.doc_id").alias("keep_id"),
        F.col("size").cast("bigint").alias("group_size"),
        (F.col("place.row") == F.col("keep.row")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
"""


@query(OP7_SQL)
def op7_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))
