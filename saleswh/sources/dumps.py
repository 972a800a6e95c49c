r"""Plain-text database dumps: several tables in one file, read in parallel.

A dump holds blocks of tab-delimited lines: a header ``COPY table (columns) FROM stdin;``, rows, and the end marker ``\.``. A file is
split among tasks at any line, so a task does not know what its lines belong to. Headers and end markers are rare; they
are gathered with their place (split, then line within the split), put in order, and each split gets the spans of
lines that belong to the wanted table. A line inside a block that looks like a header is a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The header of a block and the letters of the escapes.
HEADER = r"(?i)^COPY\s+(\S+)\s*\(([^)]*)\)\s+FROM\s+stdin;\s*$"
END = "\\."
ESCAPES = {"b": "08", "f": "0C", "n": "0A", "r": "0D", "t": "09", "v": "0B"}
TOKEN = r"(?s)(\\x[0-9A-Fa-f]{1,2}|\\[0-7]{1,3}|\\.|[^\\]+|\\)"
#: Past the last line of any split.
NEVER = (1 << 63) - 1


def unescape(c: Column) -> Column:
    r"""A field's text: ``\N`` alone is null, ``\t`` and the like are control characters, octal and hexadecimal escapes are bytes of
    UTF-8, and any other escaped character is itself.
    """
    def token(t):
        code = F.substring(t, 2, 9)
        letter = F.create_map(*[F.lit(x) for kv in ESCAPES.items() for x in kv])
        octal = F.conv((F.conv(code, 8, 10).cast("int").bitwiseAND(F.lit(255))).cast("string"), 10, 16)
        byte = (
            F.when(t.rlike(r"^\\x[0-9A-Fa-f]"), F.substring(t, 3, 2))
            .when(t.rlike(r"^\\[0-7]"), octal)
            .when(t.rlike(r"^\\[bfnrtv]$"), letter[F.substring(t, 2, 1)])
        )
        plain = F.when(t.startswith("\\") & (F.length(t) > 1), code).otherwise(t)
        return F.when(byte.isNotNull(), F.unhex(F.lpad(byte, 2, "0"))).otherwise(plain.cast("binary"))

    # tokens as hexadecimal text, so that bytes of one character may come from several escapes
    parts = F.transform(F.regexp_extract_all(c, F.lit(TOKEN), F.lit(1)), lambda t: F.hex(token(t)))
    text = F.decode(F.unhex(F.array_join(parts, "")), "UTF-8")
    return F.when(c == "\\N", F.lit(None)).when(F.contains(c, F.lit("\\")), text).otherwise(c)


def _lines(spark: SparkSession, path: str, joined: bool) -> DataFrame:
    """value, file, start (of the split in the file) and at (the line's place in its split)."""
    file = F.lit("") if joined else F.col("_metadata.file_path")
    # the parts of a joined dump follow each other by name
    start = F.struct(F.col("_metadata.file_path").alias("part"), F.col("_metadata.file_block_start").alias("byte"))
    return spark.read.option("lineSep", "\n").text(path).select(
        F.regexp_replace("value", "\r$", "").alias("value"), file.alias("file"), start.alias("start"),
        F.monotonically_increasing_id().alias("at"),
    )


def _spans(lines: DataFrame, wanted: str | None) -> DataFrame:
    """file, start, spans: of each split that holds rows of the table, the lines between ``since`` and ``until`` and their columns."""
    header = F.regexp_extract("value", HEADER, 1)
    seen = lines.groupBy("file", "start").agg(F.min("at").alias("at")).select("*", F.lit("split").alias("kind"), F.lit(None).cast("array<string>").alias("columns"))
    names = F.transform(F.split(F.regexp_extract("value", HEADER, 2), ","), lambda c: F.btrim(c, F.lit(' "')))
    marks = lines.filter((F.col("value") == END) | (header != "")).select(
        "file", "start", "at",
        F.when(F.col("value") == END, "end").otherwise(F.lower(F.btrim(header, F.lit('"')))).alias("kind"),
        F.when(header != "", names).alias("columns"),
    )
    order = Window.partitionBy("file").orderBy("start", "at")  # markers only: a few for each table of a dump
    before = F.lag("kind", 1, "end").over(order)
    # a header right after another one lies inside that block: it is a row; without a table, all headers are
    opens = F.col("before") == "end" if wanted else F.lit(False)
    real = marks.withColumn("before", before).filter((F.col("kind") == "end") | opens)
    blocks = real.unionByName(seen.withColumn("before", F.lit(None).cast("string")))
    # a split's first entry tells what its lines go on with
    open_ = F.when(F.col("kind") != "split", F.struct("kind", "columns"))
    start_with = F.struct(F.lit("" if wanted is None else "end").alias("kind"), F.lit(None).cast("array<string>").alias("columns"))
    place = Window.partitionBy("file").orderBy("start", F.col("kind") != "split", "at")
    state = F.coalesce(F.last(open_, ignorenulls=True).over(place), start_with)
    until = F.lead(F.struct("start", "at")).over(place)
    same = until["start"] == F.col("start")
    known = blocks.withColumn("state", state).withColumn("until", F.when(same, until["at"]).otherwise(F.lit(NEVER)))
    if wanted is None:
        mine = F.col("state.kind") != "end"
    else:
        name = F.col("state.kind")
        mine = (name == wanted.lower()) | name.endswith("." + wanted.lower())
    span = F.struct(F.when(F.col("kind") == "split", F.lit(-1)).otherwise(F.col("at")).alias("since"), "until", F.col("state.columns").alias("columns"))
    return known.filter(mine).groupBy("file", "start").agg(F.sort_array(F.collect_list(span)).alias("spans"))


def _rows(spark: SparkSession, path: str, table: str | None, schema: StructType, joined: bool) -> DataFrame:
    lines = _lines(spark, path, joined)
    spans = _spans(lines, table)
    inside = F.filter("spans", lambda s: (s["since"] < F.col("at")) & (F.col("at") < s["until"]))
    held = lines.join(spans, ["file", "start"]).select(F.split("value", "\t", -1).alias("f"), "value", F.inline(inside))
    width = F.coalesce(F.size("columns"), F.lit(len(schema)))
    wrong = F.raise_error(F.concat(F.lit("wrong number of fields: "), F.col("value")))
    checked = held.select("columns", F.when(F.size("f") == width, F.col("f")).otherwise(wrong).alias("f"))

    def field(i: int, name: str) -> Column:
        at = F.array_position("columns", name)
        missing = F.raise_error(F.concat(F.lit(f"no column {name} among "), F.array_join("columns", ", "))).cast("bigint")
        return F.when(F.col("columns").isNull(), F.lit(i)).when(at > 0, at - 1).otherwise(missing)

    return checked.select(
        *[unescape(F.get("f", field(i, f.name).cast("int"))).cast(f.dataType).alias(f.name) for i, f in enumerate(schema)]
    )


def read_dump(spark: SparkSession, path: str, table: str, schema: StructType, joined: bool = False) -> DataFrame:
    r"""The rows of one table of a dump, matched by the column names of its headers; other columns are left out.

    ``table`` may leave out the dump's schema name. Every file of ``path`` is a dump of its own, or, ``joined``, the files are the
    parts of one dump in name order. A table with several blocks gives the rows of all. A line with another number of fields than its header and a
    column that the header lacks are errors. Lines behind ``\.`` and outside of blocks are never rows.
    """
    return _rows(spark, path, table, schema, joined)


def read_copy_text(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    r"""Tab-delimited lines without a header, in the schema's order, up to the end marker ``\.`` of each file.

    ``\N`` is null and backslash escapes are undone; a line with another number of fields than the schema is an error. What stands
    behind the end marker is never read as a row.
    """
    return _rows(spark, path, None, schema, False)
