"""BI metrics on a small frame, against plain Python, and on empty selections."""

import random
import statistics
from collections import Counter, defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from saleswh.plans import bi

COLUMNS = (
    "order_number int, order_line_number int, quantity_ordered int, price_each double, sales decimal(12,2), "
    "deal_size string, product_code string, product_line string, msrp decimal(12,2), customer_name string, "
    "country string, order_date date, year_id int, month_id int, month_name string, qtr_id int, day_of_week string"
)


def sale(no, line, qty, sales, size, product, customer, country, day, prod_line="Cars", msrp="95.00"):
    return (
        no, line, qty, float(sales) / qty, Decimal(sales), size, product, prod_line,
        Decimal(msrp) if msrp else None, customer, country, day, day.year, day.month, day.strftime("%B"),
        (day.month - 1) // 3 + 1, day.strftime("%A"),
    )


@pytest.fixture(scope="module")
def data():
    rnd = random.Random(7)
    out = []
    for i in range(300):
        day = date(2003, 1, 1) + timedelta(days=rnd.randrange(800))
        product = f"P{rnd.randrange(20):02d}"
        out.append(
            sale(
                i // 3, i % 3, rnd.randrange(1, 50), f"{rnd.randrange(100, 900000) / 100:.2f}",
                rnd.choice(["Small", "Medium", "Large"]), product, f"C{rnd.randrange(25):02d}",
                rnd.choice(["France", "USA", None, "Japan"]), day, f"Line {product[-1]}",
                f"{90 + int(product[1:])}.00",
            )
        )
    return out


@pytest.fixture(scope="module")
def flat(spark, data):
    return spark.createDataFrame(data, COLUMNS)


@pytest.fixture(scope="module")
def empty(flat):
    return flat.filter("country = 'Nowhere'")


def sums(data, key, value=4):
    out = defaultdict(Decimal)
    for r in data:
        if r[key] is not None:
            out[r[key]] += r[value]
    return out


def best_first(totals):
    return sorted(totals.items(), key=lambda kv: (-kv[1], kv[0]))


def test_kpis(flat, data):
    k = bi.kpis(flat).collect()[0]
    total = sum(r[4] for r in data)
    orders = len({r[0] for r in data})
    assert (k.total_revenue, k.total_orders, k.total_quantity) == (total, orders, sum(r[2] for r in data))
    assert k.avg_order_value == pytest.approx(float(total) / orders)
    assert (k.unique_customers, k.unique_products) == (len({r[9] for r in data}), len({r[6] for r in data}))


def test_growth(flat, data):
    years = sorted(sums(data, 12).items())
    want = float((years[-1][1] - years[-2][1]) / years[-2][1] * 100)
    assert bi.yoy_growth(flat).collect()[0][0] == pytest.approx(want)
    assert bi.yoy_growth(flat.filter("year_id = 2003")).collect()[0][0] == 0.0


def test_groupings(flat, data):
    def pairs(df):
        return [(r[0], r[-1]) for r in df.collect()]

    assert pairs(bi.revenue_by_product_line(flat)) == best_first(sums(data, 7))
    assert pairs(bi.top_countries(flat, 2)) == best_first(sums(data, 10))[:2]  # null countries left out
    assert pairs(bi.top_customers(flat)) == best_first(sums(data, 9))[:10]
    named = defaultdict(set)
    for r in data:
        if r[10]:
            named[r[10]].add(r[9])
    assert pairs(bi.customers_by_country(flat)) == best_first({k: len(v) for k, v in named.items()})


def test_time_series(flat, data):
    months = [(r.period, r.total_sales) for r in bi.revenue_trend(flat).collect()]
    by_month = defaultdict(Decimal)
    for r in data:
        by_month[(r[12], r[13])] += r[4]
    assert months == [(f"{y}-{date(y, m, 1):%B}", s) for (y, m), s in sorted(by_month.items())]
    quarters = [r.quarter for r in bi.quarterly_revenue(flat).collect()]
    assert quarters == [f"Q{q} {y}" for y, q in sorted({(r[12], r[15]) for r in data})]
    days = [r.day_of_week for r in bi.revenue_by_weekday(flat).collect()]
    assert days == ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def test_deal_sizes(flat, data):
    got = bi.revenue_by_deal_size(flat).collect()
    assert {r.deal_size: r.total_sales for r in got} == dict(sums(data, 5))
    assert sum(r.share_pct for r in got) == pytest.approx(100)


def test_sales_statistics(flat, data):
    values = [r[4] for r in data]
    got = bi.sales_stats(flat).collect()[0]
    assert got["mean"] == pytest.approx(float(statistics.mean(values)))
    assert got["median"] == pytest.approx(float(statistics.median(values)))
    assert got["std_dev"] == pytest.approx(float(statistics.stdev(values)))
    assert (got["min"], got["max"]) == (min(values), max(values))
    odd = bi.sales_stats(flat.filter("order_line_number = 0 AND order_number < 15")).collect()[0]
    assert odd["median"] == pytest.approx(float(statistics.median(r[4] for r in data if r[1] == 0 and r[0] < 15)))


def test_median_of_repeated_amounts(spark):
    df = spark.createDataFrame([(Decimal(v),) for v in (1, 1, 1, 5, 5, 9)], "sales decimal(12,2)")
    assert bi.sales_stats(df).collect()[0]["median"] == 3.0
    one = bi.sales_stats(df.filter("sales = 9")).collect()[0]
    assert (one["median"], one["std_dev"]) == (9.0, None)


def test_order_statistics(flat, data):
    got = bi.order_stats(flat).collect()[0]
    assert got.avg_quantity == pytest.approx(statistics.mean(r[2] for r in data))
    assert got.avg_price == pytest.approx(statistics.mean(r[3] for r in data))
    by_line = defaultdict(list)
    for r in data:
        by_line[r[7]].append(r[3])
    want = best_first({k: statistics.mean(v) for k, v in by_line.items()})
    assert [r.product_line for r in bi.avg_price_by_product_line(flat).collect()] == [k for k, _ in want]


def test_best_performers_and_patterns(flat, data):
    line, country = best_first(sums(data, 7))[0], best_first(sums(data, 10))[0]
    assert tuple(bi.best_performers(flat).collect()[0]) == (*line, *country)
    deal = best_first(Counter(r[5] for r in data))[0][0]
    want = (best_first(sums(data, 15))[0][0], best_first(sums(data, 14))[0][0], deal)
    assert tuple(bi.sales_patterns(flat).collect()[0]) == want


def test_revenue_per_item(flat, data):
    want = float(sum(r[4] for r in data)) / sum(r[2] for r in data)
    assert bi.revenue_per_item(flat).collect()[0][0] == pytest.approx(want)


def test_product_performance(spark):
    d1, d2 = date(2003, 1, 1), date(2003, 1, 2)
    df = spark.createDataFrame(
        [
            sale(1, 1, 2, "10.00", "Small", "A", "x", "F", d2, "Late", "9.00"),
            sale(2, 1, 3, "20.00", "Small", "A", "x", "F", d1, "Early", None),
            sale(3, 1, 1, "30.00", "Small", "B", "x", "F", d1),
            sale(4, 1, 1, "30.00", "Small", "C", "x", "F", d1),
            sale(5, 1, 1, "99.00", "Small", None, "x", "F", d1),
        ],
        COLUMNS,
    )
    got = [(r.product_code, float(r.total_sales), r.total_quantity, float(r.msrp), r.product_line) for r in bi.product_performance(df, 2).collect()]
    # ties by code; the first known list price, and the line of the first day
    assert got == [("A", 30.0, 5, 9.0, "Early"), ("B", 30.0, 1, 95.0, "Cars")]


@pytest.mark.parametrize("customers,top", [(4, 0), (5, 1), (10, 2), (14, 2)])
def test_concentration(spark, customers, top):
    day = date(2003, 1, 1)
    data = [sale(i, 1, 1, f"{(i + 1) * 10}.00", "Small", "A", f"c{i:02d}", "F", day) for i in range(customers)]
    got = bi.revenue_concentration(spark.createDataFrame(data, COLUMNS)).collect()[0]
    values = sorted((float(r[4]) for r in data), reverse=True)
    assert got.top_customers == top
    assert got.concentration_pct == pytest.approx(sum(values[:top]) / sum(values) * 100)
    assert 0 <= got.concentration_pct <= 100


def test_concentration_counts_named_customers_only(spark):
    day = date(2003, 1, 1)
    data = [sale(i, 1, 1, "10.00", "Small", "A", f"c{i}", "F", day) for i in range(5)]
    data.append(sale(9, 1, 1, "50.00", "Small", "A", None, "F", day))
    got = bi.revenue_concentration(spark.createDataFrame(data, COLUMNS)).collect()[0]
    assert (got.top_customers, got.concentration_pct) == (1, 10.0)


def test_filters(flat, data):
    def count(**kw):
        return bi.filter_sales(flat, **kw).count()

    day = sorted(r[11] for r in data)[50]
    assert count() == 300
    assert count(date_from=day) == 300  # one end only: no date filter
    assert count(date_from=day, date_to=day) == sum(r[11] == day for r in data)
    assert count(country="USA", deal_size="Small") == sum(r[10] == "USA" and r[5] == "Small" for r in data)
    assert count(product_line="Line 3", country="All") == sum(r[7] == "Line 3" for r in data)


def test_empty_selection(empty):
    k = bi.kpis(empty).collect()[0]
    assert [float(v) for v in k] == [0, 0, 0, 0, 0, 0]
    assert rows(bi.yoy_growth(empty)) == [(0.0,)]
    assert rows(bi.revenue_concentration(empty)) == [(0, 0.0)]
    assert rows(bi.revenue_per_item(empty)) == [(0.0,)]
    assert rows(bi.sales_stats(empty)) == [(None, None, None, None, None)]
    for metric in (
        bi.best_performers, bi.sales_patterns, bi.top_countries, bi.revenue_trend, bi.quarterly_revenue,
        bi.revenue_by_weekday, bi.revenue_by_deal_size, bi.product_performance, bi.customers_by_country,
    ):
        assert rows(metric(empty)) == []
    stats = bi.order_stats(empty).collect()[0]
    assert (stats.avg_quantity, stats.total_customers) == (None, 0)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("metric", [bi.kpis, bi.order_stats, bi.customers_by_country])
def test_distinct_counts_copy_no_rows(flat, metric):
    assert "Expand" not in plan_of(metric(flat))


def test_cube_answers_filtered_kpis(spark):
    """Sums are exact, counts within the sketch's error, and the lines are not read again."""
    from saleswh.storage import stage

    day = F.date_add(F.lit("2003-01-01").cast("date"), (F.col("id") % 30).cast("int"))
    lines = spark.range(0, 60_000, 1, 4).select(
        (F.col("id") / 3).cast("bigint").alias("order_number"), F.lit(2).alias("quantity_ordered"), F.lit(1.5).cast("decimal(12,2)").alias("sales"),
        (F.col("id") % 700).cast("string").alias("customer_name"), (F.col("id") % 91).cast("string").alias("product_code"),
        day.alias("order_date"), (F.col("id") % 7).cast("string").alias("product_line"), F.when(F.col("id") % 5 > 0, "FR").alias("country"), F.lit("Small").alias("deal_size"),
    )
    cube = stage(bi.kpi_cube(lines), "cube")
    for chosen in ({}, {"country": "FR"}, {"product_line": "3", "date_from": "2003-01-05", "date_to": "2003-01-20"}):
        got, want = (bi.kpis(bi.filter_sales(lines, **chosen)).collect()[0], bi.cube_kpis(bi.filter_sales(cube, **chosen)).collect()[0])
        assert (got.total_revenue, got.total_quantity) == (want.total_revenue, want.total_quantity)
        for c in ("total_orders", "unique_customers", "unique_products"):
            assert got[c] == pytest.approx(want[c], rel=0.03)
    nothing = bi.cube_kpis(bi.filter_sales(cube, country="XX")).collect()[0]
    assert tuple(nothing) == (0, 0, 0, 0.0, 0, 0)
