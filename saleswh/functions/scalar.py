"""Column helpers. Each one is built-in expressions only, so it stays in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats the input files and scripts use.
TIMESTAMP_WITH_HOUR_OFFSET = "yyyy-MM-dd HH:mmX"  # 2025-10-07 11:00-06
SALES_FILE_DATE = "M/d/yyyy H:mm"  # 2/24/2003 0:00

# English month and weekday names.
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

MONEY = "decimal(12,2)"
MONEY_SUM = "decimal(22,2)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _names(names) -> Column:
    return F.array(*[F.lit(n) for n in names])


def month_name(d) -> Column:
    """English month name, e.g. February. A lookup: formatting each date costs far more."""
    return F.element_at(_names(MONTHS), F.month(_c(d)))


def day(d) -> Column:
    return F.dayofmonth(_c(d))


def day_name(d) -> Column:
    """English weekday name, e.g. Monday."""
    return F.element_at(_names(WEEKDAYS), iso_weekday(d))


def weekday_place(name) -> Column:
    """Monday 1 .. Sunday 7, from the weekday name."""
    return F.array_position(_names(WEEKDAYS), _c(name))


def iso_weekday(d) -> Column:
    """Monday 1 .. Sunday 7."""
    return F.weekday(_c(d)) + 1


def qtr_id(d) -> Column:
    return F.quarter(_c(d))


def month_id(d) -> Column:
    return F.month(_c(d))


def year_id(d) -> Column:
    return F.year(_c(d))


def to_date(ts) -> Column:
    return F.to_date(_c(ts))


def to_ts(s, fmt: str = TIMESTAMP_WITH_HOUR_OFFSET) -> Column:
    return F.to_timestamp(_c(s), fmt)


def to_double(n) -> Column:
    return _c(n).cast("double")


def to_money(n) -> Column:
    return _c(n).cast(MONEY)


def period_label(year, month) -> Column:
    """2003-February"""
    return F.concat_ws("-", _c(year).cast("string"), _c(month))


def quarter_label(quarter, year) -> Column:
    """Q1 2003"""
    return F.concat(F.lit("Q"), _c(quarter).cast("string"), F.lit(" "), _c(year).cast("string"))


def ratio(a, b) -> Column:
    """a / b as double; 0 when b is null or not above 0."""
    a, b = to_double(a), to_double(b)
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def pct(part, whole) -> Column:
    """part as a percentage of whole; 0 when whole is null or 0."""
    part, whole = to_double(part), to_double(whole)
    return F.coalesce(F.when(whole != 0, part / whole * 100), F.lit(0.0))


def share_count(n, fraction: float) -> Column:
    """How many of n make up the given fraction, rounded down."""
    return F.floor(to_double(n) * F.lit(float(fraction))).cast("bigint")


def to_mb(n_bytes) -> Column:
    return to_double(n_bytes) / F.lit(1048576.0)


def set_size(values) -> Column:
    return F.size(_c(values))


def now() -> Column:
    return F.current_timestamp()


def money_sum(col) -> Column:
    """Exact sum of a money column."""
    return F.sum(_c(col)).cast(MONEY_SUM)


def in_order(*cols: str) -> list[Column]:
    """Ascending sort keys with nulls last."""
    return [F.col(c).asc_nulls_last() for c in cols]


def largest_first(value: str, *ties: str) -> list[Column]:
    """Descending by value, ties by the given keys ascending; nulls last."""
    return [F.col(value).desc_nulls_last(), *in_order(*ties)]
