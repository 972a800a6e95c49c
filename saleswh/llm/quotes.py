"""Chat formatting: quotation linking.

A line's quote level is the number of ``>`` in front of it. Runs of lines of one level form passages.
Quoted passages are normalised (markers off, lower case, white space collapsed) and hashed, as a whole and line by
line, and each is linked to the latest message before it in the conversation that has the same hash among its own passages
and lines. Of the originals of a message's first-level quotes the one with most matched characters, then the latest, is
what it replies to; deeper levels are linked to their originals but decide nothing. A message without such a link
replies to the one before it.

The first reply to a message goes on in its branch and every later one opens a branch of its own.
Conversations are read in the order (branch, turn): a message never comes before what it replies to,
and quotes are gone, since what they repeat is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleswh.llm.registry import query, table
from saleswh.storage import stage

_MARKER = r"^(?:[ \t]*>)+ ?"
#: Turns of a conversation looked at in one window.
SPAN = 1000


def _lines(rows: DataFrame) -> DataFrame:
    """conv, turn, row, line_no, level, passage (number of the run), body: one row per line."""
    line = F.split(F.regexp_replace(F.coalesce("text", F.lit("")), "\r", ""), "\n")
    found = F.transform(line, lambda x: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(x, _MARKER, 0), "[^>]", "")).alias("level"),
        F.regexp_replace(x, _MARKER, "").alias("body"),
    ))
    rows = rows.select("conv", "turn", "row", found.alias("found"))
    starts = F.transform("found", lambda x, i: F.struct(
        x["level"].alias("level"), x["body"].alias("body"),
        F.when((i == 0) | (x["level"] != F.get(F.col("found"), i - 1)["level"]), 1).otherwise(0).alias("start"),
    ))
    # a line's passage is how many passages began up to it
    upto = Window.partitionBy("row").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.select("conv", "turn", "row", F.posexplode(starts).alias("line_no", "x"))
        .select("conv", "turn", "row", "line_no", "x.level", "x.body", F.sum("x.start").over(upto).alias("passage"))
    )


def _normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[\x20\x09-\x0D]+", " "))


def _units(lines: DataFrame) -> DataFrame:
    """conv, turn, level, passage, unit (hash), chars: each passage and each of its lines, normalised, none empty."""
    bodies = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "body"))), lambda x: x["body"])
    whole = lines.groupBy("conv", "turn", "row", "level", "passage").agg(F.array_join(bodies, "\n").alias("body"))
    both = whole.unionByName(lines.drop("line_no")).withColumn("norm", _normal(F.col("body"))).filter("norm != ''")
    return both.select(
        "conv", "turn", "level", "passage", F.md5("norm").alias("unit"), F.length("norm").alias("chars")
    ).distinct()


def _links(quoted: DataFrame, originals: DataFrame) -> DataFrame:
    """quoted with ``of``, the latest earlier turn whose own passages or lines have the unit; quotes without one are left out.

    A row for each quote at most: both sides pass in turns, SPAN turns of a conversation and unit at a time, and the last original of
    each span is handed on to the next ones.
    """
    none = F.lit(None)
    asked = quoted.withColumn("of", none.cast(originals.schema["of"].dataType))
    told = originals.withColumn("turn", F.col("of"))
    # a message does not quote itself, so of one turn the quotes come first
    events = stage(
        asked.unionByName(told, allowMissingColumns=True).withColumn("span", F.floor(F.col("turn") / SPAN)), "quotes"
    )
    inside = Window.partitionBy("conv", "unit", "span").orderBy("turn", F.col("of").isNotNull())
    inside = inside.rowsBetween(Window.unboundedPreceding, 0)
    found = events.withColumn("inside", F.last("of", ignorenulls=True).over(inside)).filter("of is null").drop("of")
    spans = Window.partitionBy("conv", "unit").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    carried = events.groupBy("conv", "unit", "span").agg(F.max("of").alias("last"))
    carried = carried.select("conv", "unit", "span", F.last("last", ignorenulls=True).over(spans).alias("carried"))
    linked = found.join(carried.filter("carried is not null"), ["conv", "unit", "span"], "left")
    return linked.withColumn("of", F.coalesce("inside", "carried")).filter("of is not null").drop("inside", "carried", "span")


def _trimmed(text: Column) -> Column:
    """text without blank lines at its ends, in time that grows with its length."""
    body = F.regexp_replace(text, r"^[\x20\x09-\x0D]*\n", "")
    bare = F.rtrim(body, F.lit(" \t\n\x0b\x0c\r"))
    return F.concat(bare, F.substring_index(F.substr(body, F.length(bare) + 1), "\n", 1))


def _before(turns: DataFrame) -> DataFrame:
    """conv, turn, before: the turn ahead of each one, in windows of SPAN turns and one over the spans."""
    turns = turns.withColumn("span", F.floor(F.col("turn") / SPAN))
    inside = F.lag("turn").over(Window.partitionBy("conv", "span").orderBy("turn"))
    spans = turns.groupBy("conv", "span").agg(F.max("turn").alias("last"))
    spans = spans.select("conv", "span", F.lag("last").over(Window.partitionBy("conv").orderBy("span")).alias("last"))
    return turns.withColumn("inside", inside).join(spans, ["conv", "span"]).select(
        "conv", "turn", F.coalesce("inside", "last").alias("before")
    )


def _branches(replies: DataFrame) -> DataFrame:
    """conv, turn, branch (the turn that opened it): links of first replies are followed by pointer doubling."""
    firsts = replies.filter("reply_to is not null").groupBy("conv", "reply_to").agg(F.min("turn").alias("first"))
    onward = replies.join(firsts, ["conv", "reply_to"], "left").select(
        "conv", "turn", F.when(F.col("first") == F.col("turn"), F.col("reply_to")).otherwise(F.col("turn")).alias("to")
    )
    # a conversation with one message that leads nowhere is one branch
    heads = onward.groupBy("conv").agg(
        F.count(F.when(F.col("to") == F.col("turn"), 1)).alias("heads"), F.min("turn").alias("root")
    )
    single = onward.join(heads.filter("heads = 1"), "conv").select("conv", "turn", F.col("root").alias("to"))
    now = stage(onward.join(heads.filter("heads > 1").select("conv"), "conv", "left_semi"), "branches")
    while True:
        ahead = now.select("conv", F.col("turn").alias("to"), F.col("to").alias("farther"))
        jumped = stage(now.join(ahead, ["conv", "to"]).select("conv", "turn", F.col("farther").alias("to"), F.col("to").alias("was")), "branches")
        now = jumped.drop("was")
        if jumped.filter("to != was").isEmpty():
            break
    return single.unionAll(now).withColumnRenamed("to", "branch")


def reply_order(
    messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per row of messages: conv_id, turn, role, clean_text, n_quotes, n_linked, reply_to, branch.

    n_quotes: quoted passages; n_linked: those with an original found; reply_to: turn replied to, null for a conversation's first;
    branch: turn that opened the branch; clean_text: the lines that quote nothing, without blank ones at the
    ends. Rows of one conversation and turn are one message and share its links. A row without conversation
    or turn has no links and no branch. Null texts have no quotes. Other columns are not read. No rows give no rows.
    """
    rows = stage(messages.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), F.col(f"`{role}`").alias("role"),
        F.col(f"`{text}`").alias("text"), F.monotonically_increasing_id().alias("row"),
    ), "messages")
    placed = rows.filter("conv is not null and turn is not null")
    quoting = rows.filter(F.coalesce(F.regexp_like("text", F.lit(r"(?m)^[ \t]*>")), F.lit(False)))
    lines = stage(_lines(quoting), "quoting")
    quoted = _units(lines.filter("level > 0 and conv is not null and turn is not null"))
    # originals: own lines of every message of a conversation in which someone quotes
    own = _lines(placed.join(quoted.select("conv").distinct(), "conv", "left_semi")).filter("level = 0")
    originals = _units(own).select("conv", F.col("turn").alias("of"), "unit").distinct()
    links = stage(_links(quoted, originals), "links")
    best = (
        links.filter("level = 1").groupBy("conv", "turn", "of").agg(F.sum("chars").alias("chars"))
        .groupBy("conv", "turn").agg(F.max_by("of", F.struct("chars", "of")).alias("linked"))
    )
    replies = stage(
        _before(placed.select("conv", "turn").distinct()).join(best, ["conv", "turn"], "left")
        .select("conv", "turn", F.coalesce("linked", "before").alias("reply_to")),
        "replies",
    )
    passages = lines.filter("level > 0 and trim(body) != ''").groupBy("row").agg(F.countDistinct("passage").alias("n_quotes"))
    linked = links.groupBy("conv", "turn").agg(F.countDistinct("passage").alias("n_linked"))
    kept = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "body"))), lambda x: x["body"])
    clean = lines.filter("level = 0").groupBy("row").agg(F.array_join(kept, "\n").alias("clean"))
    clean = lines.select("row").distinct().join(clean, "row", "left").withColumn("clean", F.coalesce("clean", F.lit("")))
    found = (
        rows.join(clean, "row", "left").join(passages, "row", "left").join(replies, ["conv", "turn"], "left")
        .join(_branches(replies), ["conv", "turn"], "left").join(linked, ["conv", "turn"], "left")
    )
    text_of = _trimmed(F.coalesce("clean", "text", F.lit("")))
    return found.select(
        F.col("conv").alias("conv_id"), "turn", "role", text_of.alias("clean_text"),
        F.coalesce("n_quotes", F.lit(0)).alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
        "reply_to", "branch",
    )


@query()
def op2_quote_threads(spark, sf_dir):
    return reply_order(table(spark, sf_dir, "conversations")).withColumn(
        "clean_sha256", F.sha2("clean_text", 256)
    ).drop("clean_text")
