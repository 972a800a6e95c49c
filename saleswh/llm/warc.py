"""WARC derivatives: metadata and plain-text conversion records of response records.

Each response yields two records that refer to it by WARC-Refers-To: ``metadata`` (application/warc-fields:
title, links, the response's HTTP headers and payload digest) and ``conversion``
(text/plain). Target, date and source digest are carried over, and every record gets digests of its
own block. All of it is column expressions; files are written with Spark's text writer, whose line
separator is the record separator, and read back by Content-Length.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswh.llm.registry import query, table

CRLF = "\r\n"
#: Fixed values of the format.
VERSION = "WARC/1.1"
HTML_HEAD = "HTTP/1.1 200 OK" + CRLF + "Content-Type: text/html; charset=utf-8"
DATE = "2024-01-01T00:00:00Z"

_HIDDEN = r"(?is)<!--.*?-->|<(?:script|style|noscript|template)\b.*?</(?:script|style|noscript|template)\s*>"
_BREAKS = (
    r"(?i)</?(?:address|article|aside|blockquote|body|br|caption|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|"
    r"h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul)\b[^>]*>"
)
#: A character reference, text without any, or a lone ampersand: together they cover every text.
_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});|[^&]+|&"
_HREF = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
_QUOTES = r"""^["']|["']$"""
#: Named references with their semicolon.
NAMES = {name: char for name, char in html5.items() if name.endswith(";")}
#: Maps that the names are dealt to, so that a look-up walks through a few.
_MAPS = 256


def sha256_label(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block, 256))


def record_id(kind: Column, of: Column) -> Column:
    """A name-based URN: the same record gets the same ID in every run."""
    h = F.md5(F.concat_ws("|", kind, of))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))), F.lit(">"))


def _name_literal() -> Column:
    maps: list[dict[str, str]] = [{} for _ in range(_MAPS)]
    for name, char in NAMES.items():
        maps[zlib.crc32(name.encode()) % _MAPS][name] = char
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string,string>>")


def decoded(text: Column) -> Column:
    """All character references that end in a semicolon, named, decimal and hexadecimal, as characters.

    One pass from left to right, so what a reference yields is never decoded again. Unknown names, numbers that are no character
    and control characters below the tab stay as they are.
    """
    maps = _name_literal()

    def character(code: Column) -> Column:
        good = ((code > 8) & (code < 0xD800)) | ((code > 0xDFFF) & (code < 0x110000))
        return F.decode(F.unhex(F.lpad(F.hex(F.when(good, code)), 8, "0")), "UTF-32")

    def token(t: Column) -> Column:
        name = F.substring(t, 2, 40)
        number = F.substring(t, F.lit(3), F.length(t) - 3)
        hexa = F.conv(F.substring(t, F.lit(4), F.length(t) - 4), 16, 10)
        named = F.try_element_at(F.get(maps, (F.crc32(name.cast("binary")) % _MAPS).cast("int")), name)
        found = (
            F.when(~t.startswith("&") | (t == "&"), t)
            .when(F.lower(F.substring(t, 1, 3)) == "&#x", character(hexa.cast("bigint")))
            .when(t.startswith("&#"), character(number.cast("bigint")))
            .otherwise(named)
        )
        return F.coalesce(found, t)

    joined = F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0)), token), "")
    return F.when(F.contains(text, F.lit("&")), joined).otherwise(text)


def _stripped(html: Column) -> Column:
    """Text without tags, block elements as line ends."""
    text = F.regexp_replace(html, _HIDDEN, " ")
    return F.regexp_replace(F.regexp_replace(text, _BREAKS, "\n"), r"<[^>]*>", "")


def _collapsed(text: Column) -> Column:
    """White space as one space, around line ends as none; line ends as one, at both sides as none."""
    text = F.regexp_replace(text, r"[ \t\r\f\x0B\x{A0}]+", " ")
    # spaces stand alone by now, so plain replacements take those at line ends
    for edge in (" \n", "\n "):
        text = F.replace(text, F.lit(edge), F.lit("\n"))
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"\n{2,}", "\n"), r"^\n+|\n+$", ""))


def plain_text(html: Column) -> Column:
    """Visible text: block elements on lines of their own, white space collapsed, references decoded."""
    return _collapsed(decoded(_stripped(html)))


def responses(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Response records of a page table; null URLs and bodies count as empty."""
    uri = F.coalesce(F.col(f"`{url}`"), F.lit(""))
    source = F.concat_ws(" ", F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")), uri)
    return pages.select(
        F.col(f"`{key}`").alias("page_id"), record_id(F.lit("response"), source).alias("record_id"), uri.alias("target_uri"),
        F.lit(DATE).alias("date"), F.concat(F.lit(HTML_HEAD + CRLF * 2), F.coalesce(F.col(f"`{html}`"), F.lit(""))).alias("block"),
    )


def derivatives(found: DataFrame) -> DataFrame:
    """Two records per response: page_id, record_type, record_id, refers_to, target_uri, date, content_type,
    source_payload_digest, block, block_digest, content_length.

    found: page_id, record_id, target_uri, date and block of responses (HTTP headers, an empty line, the body). A block
    without the empty line is all headers. An empty body yields an empty conversion record. Repeated responses yield repeated
    records; no rows give no rows. Other columns are not read.
    """
    cut = F.instr("block", CRLF * 2)
    head = F.when(cut > 0, F.substring(F.col("block"), F.lit(1), cut - 1)).otherwise(F.col("block"))
    body = F.when(cut > 0, F.substring(F.col("block"), cut + 4, F.length("block"))).otherwise("")
    parts = found.select("page_id", F.col("record_id").alias("refers_to"), "target_uri", "date", head.alias("head"), body.alias("body"))
    # a column of its own: decoded() names its text several times, and inside inline() each of them would be worked out again
    parts = parts.withColumns({"digest": sha256_label(F.col("body")), "stripped": _stripped(F.col("body"))})
    title = F.regexp_extract("body", r"(?is)<title\b[^>]*>(.*?)</title", 1)
    title = F.trim(F.regexp_replace(title, r"\s+", " "))
    links = F.transform(F.regexp_extract_all("body", F.lit(_HREF), F.lit(1)), lambda x: F.regexp_replace(x, _QUOTES, ""))
    fields = F.concat(
        F.lit("title: "), title, F.lit(CRLF + "source-payload-digest: "), F.col("digest"), F.lit(CRLF),
        F.array_join(F.transform(links, lambda x: F.concat(F.lit("outlink: "), F.regexp_replace(x, r"\s+", " "), F.lit(CRLF))), ""),
        F.array_join(F.transform(F.split("head", CRLF), lambda x: F.concat(F.lit("http-header: "), x, F.lit(CRLF))), ""),
    )
    parts = parts.withColumns({"fields": fields, "plain": _collapsed(decoded(F.col("stripped")))})
    both = F.array(
        F.struct(F.lit("metadata").alias("record_type"), F.lit("application/warc-fields").alias("content_type"), F.col("fields").alias("block")),
        F.struct(F.lit("conversion").alias("record_type"), F.lit("text/plain; charset=utf-8").alias("content_type"), F.col("plain").alias("block")),
    )
    return parts.select("*", F.inline(both)).select(
        "page_id", "record_type", record_id(F.col("record_type"), F.col("refers_to")).alias("record_id"), "refers_to",
        "target_uri", "date", "content_type", F.col("digest").alias("source_payload_digest"), "block",
        sha256_label(F.col("block")).alias("block_digest"), F.octet_length("block").cast("bigint").alias("content_length"),
    )


def record_text(records: DataFrame) -> Column:
    """A whole record without the two line ends behind it; refers_to and the source digest are optional columns."""
    lines = [F.lit(VERSION)]
    for name, column in [
        ("WARC-Type", "record_type"), ("WARC-Record-ID", "record_id"), ("WARC-Refers-To", "refers_to"),
        ("WARC-Target-URI", "target_uri"), ("WARC-Date", "date"), ("WARC-Block-Digest", "block_digest"),
        ("WARC-Source-Payload-Digest", "source_payload_digest"), ("Content-Type", "content_type"), ("Content-Length", "content_length"),
    ]:
        if column in records.columns:
            lines.append(F.concat(F.lit(name + ": "), F.col(column).cast("string")))
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF * 2), F.coalesce("block", F.lit("")))


def write_warc(records: DataFrame, path: str, records_per_file: int = 50_000) -> None:
    """WARC files below path, gzipped as a whole; null columns are left out of a record's head."""
    writer = records.select(record_text(records).alias("value")).write.option("lineSep", CRLF * 2)
    writer.option("maxRecordsPerFile", records_per_file).option("compression", "gzip").text(path)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import gzip

    for batch in batches:
        for value in batch.column("content"):
            data, at, heads, blocks = gzip.decompress(value.as_py()), 0, [], []
            while at < len(data):
                end = data.index(b"\r\n\r\n", at)
                head = [tuple(x.split(": ", 1)) for x in data[at:end].decode().split(CRLF)[1:]]
                size = int(dict(head)["Content-Length"])
                heads.append(head)
                blocks.append(data[end + 4 : end + 4 + size].decode())
                at = end + 4 + size + 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(heads, pa.map_(pa.string(), pa.string())), pa.array(blocks, pa.string())], ["head", "block"]
            )


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """head (map) and block of every record below path; one file is one task, so files should be of moderate size."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(_parsed, "head map<string,string>, block string")


OP5_SQL = r"""
WITH r AS (
  SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS body,
    md5(concat_ws('|', 'response', concat_ws(' ', coalesce(page_id::VARCHAR, ''), coalesce(url, '')))) AS h FROM pages),
s AS (
  SELECT *, '<urn:uuid:' || substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4)
    || '-' || substr(h, 21, 12) || '>' AS refers_to, 'sha256:' || sha256(body) AS digest FROM r),
a AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(body,
    '(?is)<!--.*?-->|<(?:script|style|noscript|template)\b.*?</(?:script|style|noscript|template)\s*>', ' ', 'g'),
    '(?i)</?(?:address|article|aside|blockquote|body|br|caption|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|title|tr|ul)\b[^>]*>', chr(10), 'g'),
    '<[^>]*>', '', 'g') AS t FROM s),
n AS MATERIALIZED (SELECT MAP([{names}], [{chars}]) AS names),
c AS (
  SELECT *, array_to_string(list_transform(regexp_extract_all(t, '{reference}'), lambda x: coalesce(CASE
    WHEN NOT starts_with(x, '&') OR x = '&' THEN x
    WHEN NOT starts_with(x, '&#') THEN list_extract(map_extract(names, x), 1)
    ELSE CASE WHEN code(x) BETWEEN 9 AND 55295 OR code(x) BETWEEN 57344 AND 1114111 THEN chr(code(x)::INT) END END, x)), '') AS u FROM a, n),
e AS (
  SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(
    u,
    '[ \t\r\f\x0B\x{A0}]+', ' ', 'g'), '(?: ?\n)+ ?', chr(10), 'g'), '^\n+|\n+$', '', 'g'), ' ') AS plain,
    'title: ' || trim(regexp_replace(regexp_extract(body, '(?is)<title\b[^>]*>(.*?)</title', 1), '\s+', ' ', 'g'), ' ')
    || chr(13) || chr(10) || 'source-payload-digest: ' || digest || chr(13) || chr(10)
    || array_to_string(list_transform(regexp_extract_all(body, '{href}', 1),
      lambda x: 'outlink: ' || regexp_replace(regexp_replace(x, '{quotes}', '', 'g'), '\s+', ' ', 'g') || chr(13) || chr(10)), '')
    || 'http-header: HTTP/1.1 200 OK' || chr(13) || chr(10) || 'http-header: Content-Type: text/html; charset=utf-8' || chr(13) || chr(10) AS fields
  FROM c),
f AS (
  SELECT page_id, 'metadata' AS record_type, refers_to, target_uri, digest, fields AS block FROM e
  UNION ALL SELECT page_id, 'conversion', refers_to, target_uri, digest, plain FROM e),
g AS (SELECT *, md5(concat_ws('|', record_type, refers_to)) AS m FROM f)
SELECT page_id, record_type, '<urn:uuid:' || substr(m, 1, 8) || '-' || substr(m, 9, 4) || '-' || substr(m, 13, 4) || '-'
    || substr(m, 17, 4) || '-' || substr(m, 21, 12) || '>' AS record_id, refers_to, target_uri, '2024-01-01T00:00:00Z' AS date,
  CASE record_type WHEN 'metadata' THEN 'application/warc-fields' ELSE 'text/plain; charset=utf-8' END AS content_type,
  digest AS source_payload_digest, 'sha256:' || sha256(block) AS block_digest, strlen(block)::BIGINT AS content_length
FROM g
"""


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


#: The rule in SQL: the names come from the standard's table, numbers are read by their base.
_CODE = "CASE WHEN lower(x[3]) = 'x' THEN ('0x' || x[4:-2])::BIGINT ELSE x[3:-2]::BIGINT END"
for _key, _value in {
    "{names}": ", ".join(_quoted("&" + n) for n in NAMES), "{chars}": ", ".join(_quoted(c) for c in NAMES.values()),
    "{reference}": _REFERENCE, "{href}": _HREF.replace("'", "''"), "{quotes}": _QUOTES.replace("'", "''"), "code(x)": f"({_CODE})",
}.items():
    OP5_SQL = OP5_SQL.replace(_key, _value)


@query(OP5_SQL)
def op5_warc_derivatives(spark, sf_dir):
    return derivatives(responses(table(spark, sf_dir, "pages"))).drop("block")
