"""BI metric pack. Every metric takes the flat sales frame, filtered or not.

Groups with a null key are left out, and an empty selection never fails: sums and
ratios are 0, best-of metrics have no row.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleswh.functions import (
    MONEY_SUM,
    in_order,
    largest_first,
    money_sum,
    pct,
    period_label,
    quarter_label,
    ratio,
    share_count,
    weekday_place,
)
from saleswh.operators.keys import number_rows
from saleswh.operators.relational import previous_period, top_k
from saleswh.operators.selection import bracket, select_ranks
from saleswh.storage import stage

ALL = "All"


def filter_sales(
    flat: DataFrame,
    date_from=None,
    date_to=None,
    product_line: str = ALL,
    country: str = ALL,
    deal_size: str = ALL,
) -> DataFrame:
    """Inclusive date range (only when both ends are given) and equality filters ("All": none)."""
    out = flat
    if date_from is not None and date_to is not None:
        first, last = (F.lit(str(d)).cast("date") for d in (date_from, date_to))
        out = out.filter(F.to_date("order_date").between(first, last))
    for col, value in (("product_line", product_line), ("country", country), ("deal_size", deal_size)):
        if value != ALL:
            out = out.filter(F.col(col) == value)
    return out


def _zero_if_null(col):
    return F.coalesce(col, F.lit(0))


def _sales_per(flat: DataFrame, *keys: str) -> DataFrame:
    present = flat
    for k in keys:
        present = present.filter(F.col(k).isNotNull())
    return present.groupBy(*keys).agg(money_sum("sales").alias("total_sales"))


def distinct_counts(df: DataFrame, *columns: str) -> list[Column]:
    """The number of distinct non-null values of each column, as scalars.

    Each is an aggregation of its own in two levels, combined in the tasks, that reads its column only; counted together they would
    need a copy of every row per column.
    """
    return [df.select(c).distinct().agg(F.count(c)).scalar() for c in columns]


def _kpi_row(totals: DataFrame, orders, customers, products) -> DataFrame:
    row = totals.select(
        _zero_if_null(F.col("sales")).cast(MONEY_SUM).alias("total_revenue"),
        orders.cast("bigint").alias("total_orders"),
        _zero_if_null(F.col("quantity")).cast("bigint").alias("total_quantity"),
        customers.cast("bigint").alias("unique_customers"),
        products.cast("bigint").alias("unique_products"),
    )
    return row.select(
        "total_revenue", "total_orders", "total_quantity",
        ratio("total_revenue", "total_orders").alias("avg_order_value"),
        "unique_customers", "unique_products",
    )


def kpis(flat: DataFrame) -> DataFrame:
    totals = flat.agg(F.sum("sales").alias("sales"), F.sum("quantity_ordered").alias("quantity"))
    return _kpi_row(totals, *distinct_counts(flat, *_COUNTED))


_COUNTED = ("order_number", "customer_name", "product_code")
_CELL = ("order_date", "product_line", "country", "deal_size")


def kpi_cube(flat: DataFrame, lg_k: int = 14) -> DataFrame:
    """Sums and mergeable distinct-count sketches per day, product line, country and deal size.

    Written once, it answers ``cube_kpis`` of any ``filter_sales`` without another scan of the lines. A sketch holds up to 2^lg_k
    small registers, far fewer for the few values of one cell; its relative error is about 1 / sqrt(2^lg_k).
    """
    return flat.groupBy(*_CELL).agg(
        F.sum("sales").alias("sales"),
        F.sum("quantity_ordered").alias("quantity"),
        *[F.hll_sketch_agg(c, lg_k).alias(f"{c}_sketch") for c in _COUNTED],
    )


def cube_kpis(cube: DataFrame) -> DataFrame:
    """The columns of ``kpis`` from a cube, filtered or not; sums are exact, distinct counts estimated."""
    merged = cube.agg(
        F.sum("sales").alias("sales"),
        F.sum("quantity").alias("quantity"),
        *[F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")).alias(c) for c in _COUNTED],
    )
    return _kpi_row(merged, *[_zero_if_null(F.col(c)) for c in _COUNTED])


def yoy_growth(flat: DataFrame) -> DataFrame:
    """Growth of the last year present over the year before, in percent; 0 below two years."""
    last = previous_period(_sales_per(flat, "year_id"), "year_id", "total_sales")
    growth = pct(F.col("total_sales") - F.col("previous_total_sales"), "previous_total_sales")
    return last.agg(F.coalesce(F.max(growth), F.lit(0.0)).alias("yoy_growth_pct"))


def revenue_by_product_line(flat: DataFrame) -> DataFrame:
    return _sales_per(flat, "product_line").orderBy(*largest_first("total_sales", "product_line"))


def top_countries(flat: DataFrame, n: int = 10) -> DataFrame:
    return top_k(_sales_per(flat, "country"), "total_sales", "country", n)


def top_customers(flat: DataFrame, n: int = 10) -> DataFrame:
    return top_k(_sales_per(flat, "customer_name"), "total_sales", "customer_name", n)


def revenue_trend(flat: DataFrame) -> DataFrame:
    months = _sales_per(flat, "year_id", "month_id", "month_name")
    return months.withColumn("period", period_label("year_id", "month_name")).orderBy(
        *in_order("year_id", "month_id")
    )


def quarterly_revenue(flat: DataFrame) -> DataFrame:
    quarters = _sales_per(flat, "year_id", "qtr_id")
    return quarters.withColumn("quarter", quarter_label("qtr_id", "year_id")).orderBy(
        *in_order("year_id", "qtr_id")
    )


def revenue_by_weekday(flat: DataFrame) -> DataFrame:
    """Revenue per weekday name, Monday first."""
    return _sales_per(flat, "day_of_week").orderBy(weekday_place("day_of_week"))


def revenue_by_deal_size(flat: DataFrame) -> DataFrame:
    """Revenue per deal size and its share of the total."""
    totals = _sales_per(flat, "deal_size")
    whole = F.sum("total_sales").over(Window.partitionBy())  # over one row per deal size
    return totals.withColumn("share_pct", pct(F.col("total_sales"), whole)).orderBy("deal_size")


def customers_by_country(flat: DataFrame, n: int = 10) -> DataFrame:
    counts = (
        flat.filter(F.col("country").isNotNull())
        .groupBy("country")
        .agg(F.countDistinct("customer_name").alias("num_customers"))
    )
    return top_k(counts, "num_customers", "country", n)


def product_performance(flat: DataFrame, n: int = 15) -> DataFrame:
    """Sales and quantity per product with its first list price and line; the n best sellers.

    Rows are first reduced per (product, list price, line), which hash-aggregates before
    the shuffle; "first" is by order date, then by value.
    """
    reduced = (
        flat.filter(F.col("product_code").isNotNull())
        .groupBy("product_code", "msrp", "product_line")
        .agg(
            F.sum("sales").alias("_sales"),
            F.sum("quantity_ordered").alias("_quantity"),
            F.min("order_date").alias("_at"),
        )
    )

    def first(c):
        return F.min_by(c, F.when(F.col(c).isNotNull(), F.struct("_at", c))).alias(c)

    products = reduced.groupBy("product_code").agg(
        money_sum("_sales").alias("total_sales"),
        F.sum("_quantity").cast("bigint").alias("total_quantity"),
        first("msrp"),
        first("product_line"),
    )
    return top_k(products, "total_sales", "product_code", n)


def avg_price_by_product_line(flat: DataFrame) -> DataFrame:
    prices = (
        flat.filter(F.col("product_line").isNotNull())
        .groupBy("product_line")
        .agg(F.avg(F.col("price_each").cast("double")).alias("avg_price"))
    )
    return prices.orderBy(*largest_first("avg_price", "product_line"))


def sales_stats(flat: DataFrame) -> DataFrame:
    """Mean, exact median, sample standard deviation, minimum and maximum of line sales.

    One pass gives all but the median, and with a sketch the two amounts that enclose it; counts of amount ranges then find
    it (see select_ranks). Each pass reads the one column and shuffles a row per task and range.
    """
    amounts = flat.filter(F.col("sales").isNotNull()).select("sales")
    low, high = bracket("sales", 0.5)
    value = F.col("sales").cast("double")
    total = amounts.agg(
        F.count("*").alias("n"), F.sum("sales").alias("sum"), F.stddev_samp(value).alias("std_dev"),
        F.min("sales").alias("min"), F.max("sales").alias("max"), low.alias("low"), high.alias("high"),
    ).collect()[0]
    median = None
    if total.n:
        middle = sorted({(total.n - 1) // 2, total.n // 2})
        found = [float(v) for v, _ in select_ranks(amounts, middle, total.low, total.high)]
        median = sum(found) / len(found)
    mean = float(total.sum) / total.n if total.n else None
    kind = flat.schema["sales"].dataType.simpleString()
    return flat.sparkSession.createDataFrame(
        [(mean, median, total.std_dev, total.min, total.max)],
        f"mean double, median double, std_dev double, min {kind}, max {kind}",
    )


def order_stats(flat: DataFrame) -> DataFrame:
    means = flat.agg(
        F.avg(F.col("quantity_ordered").cast("double")).alias("avg_quantity"),
        F.avg(F.col("price_each").cast("double")).alias("avg_price"),
    )
    customers, products = distinct_counts(flat, "customer_name", "product_code")
    return means.select("*", customers.alias("total_customers"), products.alias("total_products"))


def _best(flat: DataFrame, kinds: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Best key of several groupings in one pass: {kind: (column, "sales" or "lines")}.

    One row per kind with ``key`` as text and its ``total``; the smallest key on ties.
    The data is grouped by all columns together first, so only a few rows are unfolded.
    """
    cols = [c for c, _ in kinds.values()]
    reduced = flat.groupBy(*cols).agg(F.sum("sales").alias("sales"), F.count("*").alias("lines"))
    entries = [
        F.struct(
            F.lit(kind).alias("kind"),
            F.col(c).cast("string").alias("key"),
            F.col(measure).cast(MONEY_SUM).alias("amount"),
        )
        for kind, (c, measure) in kinds.items()
    ]
    unfolded = reduced.select(F.inline(F.array(*entries))).filter(F.col("key").isNotNull())
    totals = unfolded.groupBy("kind", "key").agg(F.sum("amount").cast(MONEY_SUM).alias("total"))
    return totals.groupBy("kind").agg(
        F.min_by(F.struct("key", "total"), F.struct(-F.col("total"), F.col("key"))).alias("best")
    )


def _pick(kind: str, field: str):
    return F.max(F.when(F.col("kind") == kind, F.col(f"best.{field}")))


def best_performers(flat: DataFrame) -> DataFrame:
    best = _best(flat, {"line": ("product_line", "sales"), "country": ("country", "sales")})
    row = best.agg(
        _pick("line", "key").alias("top_product_line"),
        _pick("line", "total").alias("top_product_line_revenue"),
        _pick("country", "key").alias("top_country"),
        _pick("country", "total").alias("top_country_revenue"),
        F.count("*").alias("_n"),
    )
    return row.filter(F.col("_n") > 0).drop("_n")


def sales_patterns(flat: DataFrame) -> DataFrame:
    """Strongest quarter and month over all years, and the most common deal size."""
    best = _best(
        flat,
        {
            "quarter": ("qtr_id", "sales"),
            "month": ("month_name", "sales"),
            "deal": ("deal_size", "lines"),
        },
    )
    row = best.agg(
        _pick("quarter", "key").cast("int").alias("best_quarter"),
        _pick("month", "key").alias("best_month"),
        _pick("deal", "key").alias("most_common_deal_size"),
        F.count("*").alias("_n"),
    )
    return row.filter(F.col("_n") > 0).drop("_n")


def revenue_per_item(flat: DataFrame) -> DataFrame:
    return flat.agg(ratio(F.sum("sales"), F.sum("quantity_ordered")).alias("revenue_per_item"))


def top_fraction(totals: DataFrame, key: str, value: str, fraction: float) -> DataFrame:
    """Mark the rows that belong to the top fraction by value: columns ``rank`` and ``in_top``.

    The number of top rows is the fraction of rows with a non-null key, rounded down.
    """
    order = [F.col(key).isNull(), *largest_first(value, key)]
    ranked = number_rows(totals, order, "rank")
    k = share_count(ranked.agg(F.count(key).alias("keys")).scalar(), fraction)
    return ranked.withColumn("in_top", F.col("rank") <= k)


def revenue_concentration(flat: DataFrame, fraction: float = 0.2) -> DataFrame:
    """Share of revenue from the top customers: the given fraction of them, rounded down.

    Nobody is ranked: the total at the last top rank is selected, larger totals are summed, and of the customers who have just
    that total as many count as are still wanted, whoever they are.
    """
    totals = flat.groupBy("customer_name").agg(F.sum("sales").alias("total"))
    totals = stage(totals, "customer-totals")  # one row per customer, read a few times
    named = totals.filter(F.col("customer_name").isNotNull()).select("total")
    low, high = bracket("total", 1 - fraction)
    seen = totals.agg(
        F.count("customer_name").alias("keys"), F.sum("total").alias("whole"),
        F.count(F.when(F.col("customer_name").isNotNull(), F.col("total"))).alias("amounts"),
    ).collect()[0]
    wanted = totals.sparkSession.range(1).select(share_count(F.lit(seen.keys), fraction)).collect()[0][0]
    k = min(wanted, seen.amounts)  # totals of null come last and add nothing
    top = F.lit(0)
    if k:
        ends = named.agg(low.alias("low"), high.alias("high")).collect()[0]
        rank = seen.amounts - k
        ((last, _),) = select_ranks(named, [rank], ends.low, ends.high)
        above = named.filter(F.col("total") > F.lit(last)).agg(F.count("*").alias("n"), F.sum("total").alias("s")).collect()[0]
        top = F.lit((above.s or 0) + (k - above.n) * last)
    return totals.sparkSession.range(1).select(
        F.lit(wanted).cast("bigint").alias("top_customers"), pct(top, F.lit(seen.whole)).alias("concentration_pct")
    )
