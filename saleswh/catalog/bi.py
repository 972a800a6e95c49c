"""The BI metric pack over the wide sales frame; each query asks for its columns only."""

from pyspark.sql import functions as F

from saleswh.catalog import query
from saleswh.catalog.sql import FLAT, with_
from saleswh.operators import relational
from saleswh.plans import bi
from saleswh.plans.tables import sales_flat
from saleswh.storage import stage

FLAT_SQL = with_(FLAT)
KPI_SQL = """SELECT CAST(coalesce(sum(sales), 0) AS DECIMAL(22,2)) AS total_revenue,
  CAST(count(DISTINCT order_number) AS BIGINT) AS total_orders,
  CAST(coalesce(sum(quantity_ordered), 0) AS BIGINT) AS total_quantity,
  round(CASE WHEN count(DISTINCT order_number) > 0
        THEN CAST(sum(sales) AS DOUBLE) / count(DISTINCT order_number) ELSE 0 END, 6) AS avg_order_value,
  CAST(count(DISTINCT customer_name) AS BIGINT) AS unique_customers,
  CAST(count(DISTINCT product_code) AS BIGINT) AS unique_products FROM flat"""
KPI_COLUMNS = ["sales", "order_number", "quantity_ordered", "customer_name", "product_code"]


def _rounded(df, digits=6):
    doubles = [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


def _sums(keys, tail=""):
    return (
        FLAT_SQL + f"SELECT {keys}, CAST(sum(sales) AS DECIMAL(22,2)) AS total_sales "
        f"FROM flat GROUP BY {keys} {tail}"
    )


@query(FLAT_SQL + KPI_SQL)
def kpis(spark, d):
    return _rounded(bi.kpis(sales_flat(spark, d, KPI_COLUMNS)))


FILTER_COLUMNS = [*KPI_COLUMNS, "order_date", "product_line", "country", "deal_size"]
FILTER_SQL = """ WHERE order_date BETWEEN DATE '1996-01-01' AND DATE '1999-06-30'
  AND product_line = 'ECONOMY' AND country = 'NATION_3' AND deal_size = 'Medium'"""


@query(FLAT_SQL + KPI_SQL + FILTER_SQL)
def filtered_kpis(spark, d):
    flat = sales_flat(spark, d, FILTER_COLUMNS)
    chosen = bi.filter_sales(flat, "1996-01-01", "1999-06-30", "ECONOMY", "NATION_3", "Medium")
    return _rounded(bi.kpis(chosen))


@query(
    FLAT_SQL + "SELECT CAST(coalesce(sum(sales), 0) AS DECIMAL(22,2)) AS total_revenue, "
    "CAST(coalesce(sum(quantity_ordered), 0) AS BIGINT) AS total_quantity, "
    "TRUE AS orders_close, TRUE AS customers_close, TRUE AS products_close FROM flat" + FILTER_SQL
)
def kpis_from_cube(spark, d):
    """Filtered KPIs from the written cube; its estimates must lie within 3 % of the exact counts."""
    flat = sales_flat(spark, d, FILTER_COLUMNS)
    chosen = ("1996-01-01", "1999-06-30", "ECONOMY", "NATION_3", "Medium")
    got = bi.cube_kpis(bi.filter_sales(stage(bi.kpi_cube(flat), "kpi-cube"), *chosen))
    exact = bi.kpis(bi.filter_sales(flat, *chosen))
    pairs = {"orders_close": "total_orders", "customers_close": "unique_customers", "products_close": "unique_products"}
    close = [
        (F.abs(F.col(c) - exact.select(c).scalar()) <= 0.03 * exact.select(c).scalar()).alias(name) for name, c in pairs.items()
    ]
    return got.select("total_revenue", "total_quantity", *close)


@query(FLAT_SQL + KPI_SQL + " WHERE country = 'NOWHERE'")
def empty_kpis(spark, d):
    flat = sales_flat(spark, d, [*KPI_COLUMNS, "country"])
    return _rounded(bi.kpis(bi.filter_sales(flat, country="NOWHERE")))


@query(
    FLAT_SQL
    + """, y AS (SELECT year_id, CAST(sum(sales) AS DOUBLE) AS s FROM flat GROUP BY year_id),
    l AS (SELECT s, lag(s) OVER (ORDER BY year_id) AS p, row_number() OVER (ORDER BY year_id DESC) AS rn FROM y)
    SELECT round((s - p) / p * 100, 6) AS yoy_growth_pct FROM l WHERE rn = 1"""
)
def yoy_growth(spark, d):
    return _rounded(bi.yoy_growth(sales_flat(spark, d, ["year_id", "sales"])))


@query(_sums("product_line"))
def revenue_by_product_line(spark, d):
    return bi.revenue_by_product_line(sales_flat(spark, d, ["product_line", "sales"]))


@query(_sums("country", "ORDER BY total_sales DESC, country LIMIT 10"))
def top_countries(spark, d):
    return bi.top_countries(sales_flat(spark, d, ["country", "sales"]))


@query(_sums("customer_name", "ORDER BY total_sales DESC, customer_name LIMIT 10"))
def top_customers(spark, d):
    return bi.top_customers(sales_flat(spark, d, ["customer_name", "sales"]))


@query(
    FLAT_SQL + "SELECT year_id, month_id, month_name, CAST(sum(sales) AS DECIMAL(22,2)) AS total_sales, "
    "year_id || '-' || month_name AS period FROM flat GROUP BY year_id, month_id, month_name"
)
def revenue_trend(spark, d):
    return bi.revenue_trend(sales_flat(spark, d, ["year_id", "month_id", "month_name", "sales"]))


@query(
    FLAT_SQL + "SELECT year_id, qtr_id, CAST(sum(sales) AS DECIMAL(22,2)) AS total_sales, "
    "'Q' || qtr_id || ' ' || year_id AS quarter FROM flat GROUP BY year_id, qtr_id"
)
def quarterly_revenue(spark, d):
    return bi.quarterly_revenue(sales_flat(spark, d, ["year_id", "qtr_id", "sales"]))


@query(_sums("day_of_week"))
def revenue_by_weekday(spark, d):
    return bi.revenue_by_weekday(sales_flat(spark, d, ["day_of_week", "sales"]))


@query(
    FLAT_SQL + "SELECT deal_size, CAST(sum(sales) AS DECIMAL(22,2)) AS total_sales, "
    "round(CAST(sum(sales) AS DOUBLE) / (SELECT CAST(sum(sales) AS DOUBLE) FROM flat) * 100, 6) AS share_pct "
    "FROM flat GROUP BY deal_size"
)
def revenue_by_deal_size(spark, d):
    return _rounded(bi.revenue_by_deal_size(sales_flat(spark, d, ["deal_size", "sales"])))


@query(
    FLAT_SQL + "SELECT country, CAST(count(DISTINCT customer_name) AS BIGINT) AS num_customers FROM flat "
    "GROUP BY country ORDER BY num_customers DESC, country LIMIT 10"
)
def customers_by_country(spark, d):
    return bi.customers_by_country(sales_flat(spark, d, ["country", "customer_name"]))


@query(
    FLAT_SQL + "SELECT product_code, CAST(sum(sales) AS DECIMAL(22,2)) AS total_sales, "
    "CAST(sum(quantity_ordered) AS BIGINT) AS total_quantity, min(msrp) AS msrp, min(product_line) AS product_line "
    "FROM flat GROUP BY product_code ORDER BY total_sales DESC, product_code LIMIT 15"
)
def product_performance(spark, d):
    cols = ["product_code", "product_line", "msrp", "sales", "quantity_ordered", "order_date"]
    return bi.product_performance(sales_flat(spark, d, cols))


@query(FLAT_SQL + "SELECT product_line, round(avg(price_each), 4) AS avg_price FROM flat GROUP BY product_line")
def avg_price_by_product_line(spark, d):
    return _rounded(bi.avg_price_by_product_line(sales_flat(spark, d, ["product_line", "price_each"])), 4)


@query(
    FLAT_SQL + "SELECT round(avg(CAST(sales AS DOUBLE)), 4) AS mean, "
    "round(median(CAST(sales AS DOUBLE)), 4) AS median, "
    "round(stddev_samp(CAST(sales AS DOUBLE)), 4) AS std_dev, min(sales) AS min, max(sales) AS max FROM flat"
)
def sales_stats(spark, d):
    return _rounded(bi.sales_stats(sales_flat(spark, d, ["sales"])), 4)


@query(
    FLAT_SQL + "SELECT round(avg(quantity_ordered), 4) AS avg_quantity, round(avg(price_each), 4) AS avg_price, "
    "CAST(count(DISTINCT customer_name) AS BIGINT) AS total_customers, "
    "CAST(count(DISTINCT product_code) AS BIGINT) AS total_products FROM flat"
)
def order_stats(spark, d):
    cols = ["quantity_ordered", "price_each", "customer_name", "product_code"]
    return _rounded(bi.order_stats(sales_flat(spark, d, cols)), 4)


@query(
    FLAT_SQL
    + """, p AS (SELECT product_line, CAST(sum(sales) AS DECIMAL(22,2)) AS s FROM flat GROUP BY 1
               ORDER BY s DESC, 1 LIMIT 1),
         c AS (SELECT country, CAST(sum(sales) AS DECIMAL(22,2)) AS s FROM flat GROUP BY 1
               ORDER BY s DESC, 1 LIMIT 1)
    SELECT product_line AS top_product_line, p.s AS top_product_line_revenue, country AS top_country,
           c.s AS top_country_revenue FROM p, c"""
)
def best_performers(spark, d):
    return bi.best_performers(sales_flat(spark, d, ["product_line", "country", "sales"]))


@query(
    FLAT_SQL
    + """, q AS (SELECT qtr_id FROM flat GROUP BY 1 ORDER BY sum(sales) DESC, 1 LIMIT 1),
         m AS (SELECT month_name FROM flat GROUP BY 1 ORDER BY sum(sales) DESC, 1 LIMIT 1),
         s AS (SELECT deal_size FROM flat GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
    SELECT qtr_id AS best_quarter, month_name AS best_month, deal_size AS most_common_deal_size FROM q, m, s"""
)
def sales_patterns(spark, d):
    return bi.sales_patterns(sales_flat(spark, d, ["qtr_id", "month_name", "deal_size", "sales"]))


@query(
    FLAT_SQL + "SELECT round(CASE WHEN sum(quantity_ordered) > 0 "
    "THEN CAST(sum(sales) AS DOUBLE) / sum(quantity_ordered) ELSE 0 END, 6) AS revenue_per_item FROM flat"
)
def revenue_per_item(spark, d):
    return _rounded(bi.revenue_per_item(sales_flat(spark, d, ["sales", "quantity_ordered"])))


@query(
    FLAT_SQL
    + """, t AS (SELECT customer_name, sum(sales) AS s FROM flat GROUP BY customer_name),
         r AS (SELECT s, row_number() OVER (ORDER BY s DESC, customer_name) AS rn, count(*) OVER () AS n FROM t)
    SELECT CAST(count(*) FILTER (rn <= floor(n * 0.2)) AS BIGINT) AS top_customers,
           round(CAST(sum(s) FILTER (rn <= floor(n * 0.2)) AS DOUBLE) / CAST(sum(s) AS DOUBLE) * 100, 6)
             AS concentration_pct FROM r"""
)
def revenue_concentration(spark, d):
    return _rounded(bi.revenue_concentration(sales_flat(spark, d, ["customer_name", "sales"])))


@query(FLAT_SQL + "SELECT DISTINCT country FROM flat ORDER BY country")
def choices(spark, d):
    return relational.choices(sales_flat(spark, d, ["country"]), "country")


@query(FLAT_SQL + "SELECT min(order_date) AS min_date, max(order_date) AS max_date FROM flat")
def date_bounds(spark, d):
    return relational.date_bounds(sales_flat(spark, d, ["order_date"]))
