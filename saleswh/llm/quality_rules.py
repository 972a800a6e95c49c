r"""Quality rules as one projection.

A table of thresholds (``RULES``) names ratios of counts of a text: word length, symbols per word, stop words, kinds of
words, kinds of lines. It is compiled into one projection of built-in expressions: a first layer counts, a second
compares each ratio with its bounds. No user function, no shuffle: a row's verdict depends on its text alone.

Words are ``[^\x20\x09-\x0D]+``, lines are split at ``\n``; a line without a word is no line here.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleswh.llm.registry import query, table

#: Runs of blank, tab, line feed, vertical tab, form feed and carriage return.
WHITE = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Words in a window of the repetition count.
WINDOW = 8
#: Base rules: fewer words, or more repeated words per hundred, fail whatever the table says.
MIN_WORDS = 20
MAX_REPEATED = 30
#: Marks that are cut from both ends of a word before it is looked up among the stop words.
MARKS = ".,;:!?\"'()"
# Frequent function words of English, German, Spanish and French.
STOP_WORDS = (
    "a an and are as at be but by for from has have he in is it not of on or that the this to was were which with you "
    "als am auch auf aus bei das dem den der des die ein eine er es für ich im ist mit nicht sich sie so und von war wie zu "
    "al como con de del el en ella es esta la las lo los más no para pero por que se su un una y "
    "au avec ce dans des du elle est et il je le les mais ne ou par pas pour qui sur une"
).split()


@dataclass(frozen=True)
class Rule:
    """A text passes when low <= part / whole <= high; a whole of zero passes."""

    name: str
    part: str
    whole: str
    low: float | None = None
    high: float | None = None


#: The threshold table; parts and wholes are counts of ``counts_of``.
RULES = (
    Rule("mean_word_length", "word_chars", "n_words", 2, 14),
    Rule("symbols_per_word", "n_symbols", "n_words", high=0.1),
    Rule("stop_word_share", "n_stop_words", "n_words", low=0.02),
    Rule("letter_word_share", "n_letter_words", "n_words", low=0.8),
    Rule("capital_word_share", "n_capital_words", "n_words", high=0.3),
    Rule("repeated_line_share", "n_dup_lines", "n_lines", high=0.5),
    Rule("bullet_line_share", "n_bullet_lines", "n_lines", high=0.9),
    Rule("ellipsis_line_share", "n_ellipsis_lines", "n_lines", high=0.3),
)
BASE_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

HAS_WORD = r"[^\x20\x09-\x0D]"
BULLET = r"^[\x20\x09]*[-*•‣]"
ELLIPSIS = r"(\.\.\.|…)[\x20\x09\x0D]*$"
LETTER, UPPER, LOWER = r"\p{L}", r"\p{Lu}", r"\p{Ll}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _size(items: Column) -> Column:
    return F.size(items).cast("bigint")


def _neighbours_equal(items: Column, e: Column, i: Column, field: str) -> Column:
    """Whether an entry of a sorted array equals the one before or after it in a field."""
    same = [F.coalesce(F.get(items, j)[field] == e[field], F.lit(False)) for j in (i - 1, i + 1)]
    return same[0] | same[1]


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Number of words in windows that occur twice or more, the first occurrence included.

    Windows are compared by hash first; those that share a hash are compared by their words, so the number is exact.
    """

    def covered(starts: Column) -> Column:
        gaps = F.transform(starts, lambda s, i: F.least(F.lit(window), F.coalesce(F.get(starts, i + 1) - s, F.lit(window))))
        return F.aggregate(gaps, F.lit(0), lambda a, b: a + b)

    def by_words(likely: Column) -> Column:
        cut = F.transform(likely, lambda e: F.struct(F.slice(words, e["i"] + 1, window).alias("w"), e["i"].alias("i")))
        return let(
            F.sort_array(cut),
            lambda s: let(
                F.sort_array(F.transform(F.filter(s, lambda e, i: _neighbours_equal(s, e, i, "w")), lambda e: e["i"])), covered
            ),
        )

    def by_hash(hashes: Column) -> Column:
        entries = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        found = let(F.sort_array(entries), lambda s: by_words(F.filter(s, lambda e, i: _neighbours_equal(s, e, i, "h"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(found)

    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - window),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(window)]),
    )
    return F.when(F.size(words) <= window, F.lit(0)).otherwise(let(hashes, by_hash)).cast("bigint")


def counts_of(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """All counts of a text as one struct; null counts as empty."""
    text = F.coalesce(text, F.lit(""))

    def length_without(chars: str) -> Column:
        return F.length(F.translate(text, chars, "")).cast("bigint")

    def of_words(words: Column) -> dict[str, Column]:
        bare = F.transform(words, lambda w: F.btrim(F.lower(w), F.lit(MARKS)))
        return {
            "n_words": _size(words),
            "word_chars": length_without(BLANKS),
            "n_symbols": F.length(text).cast("bigint") - length_without(SYMBOLS),
            "n_repeat_words": repeated_words(words),
            "n_stop_words": _size(F.filter(bare, lambda w: w.isin(list(stop_words)))),
            "n_letter_words": _size(F.filter(words, lambda w: w.rlike(LETTER))),
            "n_capital_words": _size(F.filter(words, lambda w: (F.length(w) > 1) & w.rlike(UPPER) & ~w.rlike(LOWER))),
        }

    def of_lines(lines: Column) -> dict[str, Column]:
        return {
            "n_lines": _size(lines),
            "n_dup_lines": _size(lines) - _size(F.array_distinct(lines)),
            "n_bullet_lines": _size(F.filter(lines, lambda s: s.rlike(BULLET))),
            "n_ellipsis_lines": _size(F.filter(lines, lambda s: s.rlike(ELLIPSIS))),
        }

    words = F.array_remove(F.split(text, WHITE, -1), "")
    lines = F.filter(F.split(text, "\n", -1), lambda s: s.rlike(HAS_WORD))
    return let(
        F.struct(words.alias("words"), lines.alias("lines")),
        lambda t: F.struct(*[c.alias(k) for k, c in {**of_words(t["words"]), **of_lines(t["lines"])}.items()]),
    )


def compile_rules(rules: Sequence[Rule], count: Callable[[str], Column]) -> dict[str, Column]:
    """The table as columns: each rule's ratio, and ``failed``, the names of the rules that do not hold, joined by commas."""
    ratios = {r.name: count(r.part) / F.nullif(count(r.whole), F.lit(0)) for r in rules}
    broken = []
    for r in rules:
        # compared without dividing, so that a ratio at its bound passes whatever the rounding
        part, whole = count(r.part), count(r.whole)
        outside = F.lit(False)
        if r.low is not None:
            outside = outside | (part < F.lit(float(r.low)) * whole)
        if r.high is not None:
            outside = outside | (part > F.lit(float(r.high)) * whole)
        broken.append(F.when(outside, F.lit(r.name)))
    return {**ratios, "failed": F.concat_ws(",", *broken)}


def quality_rules(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    rules: Sequence[Rule] = RULES,
    stop_words: Sequence[str] = STOP_WORDS,
) -> DataFrame:
    """One row per row of docs: doc_id, the five base counts, base_failed, kept, the ratios and ``failed``.

    A null text counts as empty: no words, so the base rules fail. Null and repeated keys are carried as they are, each row
    is judged alone, equal texts alike. Lines and windows are compared exactly. Ratios over no words or no lines are null
    and pass. Very long texts need memory for their words. Other columns are not read, whatever their names. No rows give no rows.
    """
    counted = docs.select(F.col(f"`{key}`").alias("doc_id"), counts_of(F.col(f"`{text}`"), stop_words).alias("counts"))
    verdict = compile_rules(rules, lambda name: F.col("counts")[name])
    few, many = F.col("counts.n_words") < MIN_WORDS, 100 * F.col("counts.n_repeat_words") > MAX_REPEATED * F.col("counts.n_words")
    return counted.select(
        "doc_id",
        *[F.col("counts")[c].alias(c) for c in BASE_COUNTS],
        (few | many).alias("base_failed"),
        (~(few | many) & (verdict["failed"] == "")).alias("kept"),
        *[c.alias(name) for name, c in verdict.items()],
    )


def _sql_rules() -> tuple[str, str]:
    """The table's ratios and its broken rules in SQL."""
    ratios, broken = [], []
    for r in RULES:
        ratios.append(f"CAST({r.part} AS DOUBLE) / nullif({r.whole}, 0) AS {r.name}")
        tests = [f"{r.part} < {float(r.low)!r}::DOUBLE * {r.whole}"] if r.low is not None else []
        tests += [f"{r.part} > {float(r.high)!r}::DOUBLE * {r.whole}"] if r.high is not None else []
        broken.append(f"CASE WHEN {' OR '.join(tests)} THEN '{r.name}' END")
    return ", ".join(ratios), f"concat_ws(',', {', '.join(broken)})"


_RATIOS, _BROKEN = _sql_rules()
OP12_SQL = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '{HAS_WORD}')) AS lines FROM documents),
w AS (SELECT r, unnest(generate_series(1, len(words) - {WINDOW - 1})) AS i, words FROM d WHERE len(words) >= {WINDOW}),
x AS (SELECT r, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS s FROM w),
t AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM x) WHERE n > 1),
c AS (SELECT r, count(DISTINCT i + k) AS n FROM t, range({WINDOW}) AS o(k) GROUP BY r),
m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
    len(list_filter(words, lambda z: trim(lower(z), '{MARKS.replace("'", "''")}')
        IN ({', '.join(f"'{s}'" for s in sorted(set(STOP_WORDS)))}))) AS n_stop_words,
    len(list_filter(words, lambda z: regexp_matches(z, '{LETTER}'))) AS n_letter_words,
    len(list_filter(words, lambda z: length(z) > 1 AND regexp_matches(z, '{UPPER}') AND NOT regexp_matches(z, '{LOWER}')))
      AS n_capital_words,
    len(list_filter(lines, lambda s: regexp_matches(s, '{BULLET}'))) AS n_bullet_lines,
    len(list_filter(lines, lambda s: regexp_matches(s, '{ELLIPSIS}'))) AS n_ellipsis_lines
  FROM d LEFT JOIN c USING (r)),
v AS (SELECT *, {_RATIOS}, {_BROKEN} AS failed,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM m)
SELECT doc_id, {', '.join(BASE_COUNTS)}, base_failed, NOT base_failed AND failed = '' AS kept,
  {', '.join(r.name for r in RULES)}, failed FROM v
"""


@query(OP12_SQL)
def op12_quality_rules(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents"))
