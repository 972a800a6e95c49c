"""Line dedup: repeated runs of lines, found by prefix doubling over line IDs.

A document is the sequence of its lines that are not blank; a line's ID is its rank among
all distinct lines. Prefix doubling ranks the suffixes of these sequences by their
first h lines, then by 2h: the new rank orders the pair (rank at i, rank at i + h). A
suffix that no other one shares its first h lines with is settled and leaves the rounds, so
each round works on what is still tied. Doubling stops at depth ``min_lines``. What
is tied there forms the intervals of the suffix array whose longest common prefix is at least
``min_lines`` lines. Each member of an interval but the first (in the order of documents and lines) starts a
later copy, and the windows of later copies that overlap join into maximal repeated runs.

Ranks are counted, not sorted row by row: a group's rank is its parent's rank plus the sizes of the
groups before it, summed in two levels of windows over groups, so a line that owns a
third of all rows is one row by then. Only groups with more than one row are ranked; lines that occur once never enter a window,
and both levels have some square root of the number of lines at most, as digests and ranks spread evenly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleswh.llm.pareto_mix import WORDS
from saleswh.llm.registry import query, table
from saleswh.llm.staging import settle

#: A repeated run counts from so many lines on, or as a single line of MIN_WORDS words.
MIN_LINES = 2
MIN_WORDS = 50
_SPACE = " \t\n\x0b\x0c\r"


def _trimmed(line: Column) -> Column:
    """line without white space at its ends; the right end is looked at first, as trimming it lists every character."""
    ends = F.substring(line, -1, 1).isin(list(_SPACE))
    return F.when(ends, F.trim(line, F.lit(_SPACE))).otherwise(F.ltrim(line, F.lit(_SPACE)))


def _has_words(line: Column, least: int) -> Column:
    """Whether a trimmed line that is not blank has so many words: matched once, without a list of its words."""
    space = WORDS.removeprefix("[^").removesuffix("]+")
    pattern = rf"^(?:[^{space}]++[{space}]++){{{max(least, 1) - 1}}}+[^{space}]"
    return (F.length(line) >= 2 * least - 1) & line.rlike(pattern)


def _identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """doc (key), mark (hash of the text) and text; rows that agree in both count as one document."""
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.col(f"`{key}`").alias("doc"), F.xxhash64(whole).alias("mark"), whole.alias("text"))


def _line_table(found: DataFrame, min_words: int) -> DataFrame:
    """doc, mark, pos, line_no, line (digest), long: the lines that are not blank."""
    lines = F.transform(
        F.split("text", "\n"), lambda line, i: F.struct(i.alias("line_no"), _trimmed(line).alias("line"))
    )
    return (
        found.select("doc", "mark", F.posexplode(F.filter(lines, lambda x: x["line"] != "")).alias("pos", "x"))
        .select(
            "doc", "mark", "pos", "x.line_no", F.unhex(F.md5("x.line")).alias("line"),
            _has_words(F.col("x.line"), min_words).alias("long"),
        )
        .distinct()
    )


def _place() -> Column:
    """Order of lines: documents by key, null last, then by line."""
    return F.struct(F.col("doc").isNull().alias("last"), "doc", "mark", "pos")


def _ranked(groups: DataFrame, parent: list[str], order: str, bucket: Column) -> DataFrame:
    """groups (parent, order, n) with ``before``: rows of the parent's groups that come earlier.

    Two levels: running sums over the buckets of a parent, and inside each bucket.
    """
    groups = groups.withColumn("bucket", bucket)
    earlier = (Window.unboundedPreceding, -1)
    sums = groups.groupBy(*parent, "bucket").agg(F.sum("n").alias("bucket_n"))
    over_buckets = Window.partitionBy(*parent).orderBy("bucket").rowsBetween(*earlier)
    sums = sums.select(*parent, "bucket", F.coalesce(F.sum("bucket_n").over(over_buckets), F.lit(0)).alias("base"))
    inside = Window.partitionBy(*parent, "bucket").orderBy(order).rowsBetween(*earlier)
    summed = groups.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return summed.join(sums, [*parent, "bucket"]).withColumn("before", F.col("base") + F.col("inside"))


def tied_lines(lines: DataFrame, all_lines: int) -> DataFrame:
    """doc, mark, pos, line_no, long, rank, first: the lines that occur more than once.

    rank orders them by their digests; first is the place of the first line of the rank.
    """
    groups = lines.groupBy("line").agg(F.count("*").alias("n"), F.min(_place()).alias("first")).filter("n > 1")
    # the digest's first 32 bits split all lines evenly and in order
    head = F.conv(F.substring(F.hex("line"), 1, 8), 16, 10).cast("bigint")
    bucket = F.shiftright(head * F.lit(_buckets(all_lines)), 32)
    shared = _ranked(groups, [], "line", bucket).select("line", F.col("before").alias("rank"), "first")
    return settle(lines.join(shared, "line").select("doc", "mark", "pos", "line_no", "long", "rank", "first"), "tied")


def _buckets(all_lines: int) -> int:
    return min(math.isqrt(all_lines) + 1, 1 << 30)


def tied_suffixes(tied: DataFrame, all_lines: int, depth: int) -> DataFrame:
    """doc, mark, pos, rank, first: suffixes that share their first ``depth`` lines with another one; tied: those of depth 1."""
    buckets = _buckets(all_lines)
    h = 1
    while h < depth:
        shift = min(h, depth - h)
        ahead = tied.select(F.col("doc").alias("d"), F.col("mark").alias("m"),
                            (F.col("pos") - shift).alias("p"), F.col("rank").alias("next"))
        same = F.col("doc").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")) & (F.col("pos") == F.col("p"))
        pairs = tied.join(ahead, same).select("doc", "mark", "pos", "rank", "next")
        groups = pairs.groupBy("rank", "next").agg(F.count("*").alias("n"), F.min(_place()).alias("first"))
        bucket = F.floor(F.col("next") * buckets / max(all_lines, 1))
        shared = _ranked(groups.filter("n > 1"), ["rank"], "next", bucket)
        shared = shared.select("rank", "next", (F.col("rank") + F.col("before")).alias("refined"), "first")
        tied = pairs.join(shared, ["rank", "next"]).select("doc", "mark", "pos", F.col("refined").alias("rank"), "first")
        h += shift
        if h < depth:  # the next round reads it twice
            tied = settle(tied, "tied")
    return tied


def removed_lines(found: DataFrame, min_lines: int, min_words: int) -> DataFrame:
    """doc, mark, removed (line numbers), n_runs: later copies in each document that has some."""
    lines = settle(_line_table(found, min_words), "lines")
    later = _place() > F.col("first")
    all_lines = lines.count()
    single = tied_lines(lines, all_lines)
    runs = tied_suffixes(single, all_lines, min_lines).filter(later).select(
        "doc", "mark", F.explode(F.sequence(F.col("pos"), F.col("pos") + (min_lines - 1))).alias("pos")
    )
    alone = single.filter(later & F.col("long")).select("doc", "mark", "pos")
    # every line of a repeated run is a repeated line
    spots = runs.unionAll(alone).distinct().select(F.col("doc").alias("d"), F.col("mark").alias("m"), F.col("pos").alias("p"))
    same = F.col("doc").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")) & (F.col("pos") == F.col("p"))
    per_doc = single.join(spots, same).groupBy("doc", "mark").agg(
        F.collect_list("pos").alias("spots"), F.collect_list("line_no").alias("removed")
    )
    starts = F.array_except("spots", F.transform("spots", lambda p: p + 1))
    return per_doc.select("doc", "mark", "removed", F.size(starts).cast("bigint").alias("n_runs"))


def dedup_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_lines: int = MIN_LINES,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """One row per row of docs: row (all its columns), kept_text, n_lines, n_removed, n_runs.

    Deleted are the lines of every later copy of a run of at least ``min_lines`` lines, and later copies of single
    lines of at least ``min_words`` words. Copies are judged on the input, within and across documents;
    documents are ordered by key, null last, and rows that repeat key and text are one
    document. Lines are compared without white space at their ends; blank lines are never part of a run
    and stay. A null text stays null and has no lines. Columns of docs may have any names.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    whole = F.coalesce(F.col("row").getField(text), F.lit(""))
    rows = rows.withColumn("mark", F.xxhash64(whole))
    cuts = removed_lines(_identified(docs, key, text), min_lines, min_words).withColumnRenamed("mark", "cut_mark")
    same = F.col("row").getField(key).eqNullSafe(F.col("doc")) & (F.col("mark") == F.col("cut_mark"))
    lines = F.split(whole, "\n")

    def without_removed(split: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.size(split) - 1)
        left = F.transform(F.array_except(numbers, F.col("removed")), lambda i: F.element_at(split, i + 1))
        return F.array_join(left, "\n")

    # the split text is an argument: inside the function of transform it would be computed again for every line
    kept = F.transform(F.array(lines), without_removed)[0]
    kept = F.when(F.col("removed").isNull(), F.col("row").getField(text)).otherwise(kept)
    return rows.join(cuts, same, "left").select(
        "row",
        kept.alias("kept_text"),
        F.size(F.filter(lines, lambda x: F.ltrim(x, F.lit(_SPACE)) != "")).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce(F.col("n_runs"), F.lit(0)).cast("bigint").alias("n_runs"),
    )


OP10_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(list_zip(range(len(string_split(coalesce(text, ''), chr(10)))), string_split(coalesce(text, ''), chr(10)))) AS x
  FROM documents),
n AS (
  SELECT doc_id, x[1] AS line_no, x[2] AS raw, regexp_replace(x[2], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS line FROM l),
e AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS pos FROM n WHERE line <> ''),
w AS (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS next FROM e),
c AS (
  SELECT *, row_number() OVER (PARTITION BY line, next ORDER BY doc_id, pos) > 1 AND next IS NOT NULL AS pair,
    row_number() OVER (PARTITION BY line ORDER BY doc_id, pos) > 1
      AND len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) >= 50 AS alone
  FROM w),
r AS (
  SELECT *, alone OR pair OR coalesce(lag(pair) OVER (PARTITION BY doc_id ORDER BY pos), false) AS gone FROM c),
s AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY pos), false) AS starts FROM r),
k AS (
  SELECT n.doc_id, string_agg(n.raw, chr(10) ORDER BY n.line_no) FILTER (WHERE NOT coalesce(s.gone, false)) AS kept,
    count(s.pos) AS n_lines, count(*) FILTER (WHERE s.gone) AS n_removed, count(*) FILTER (WHERE s.starts) AS n_runs
  FROM n LEFT JOIN s ON n.doc_id = s.doc_id AND n.line_no = s.line_no GROUP BY n.doc_id)
SELECT doc_id, n_lines, n_removed, n_runs, sha256(coalesce(kept, '')) AS kept_sha256 FROM k
"""


@query(OP10_SQL)
def op10_line_runs(spark, sf_dir):
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_removed", "n_runs",
        F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"),
    )
