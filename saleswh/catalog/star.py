"""Star schema build, the wide join and the three benchmark reports."""

from pyspark.sql import functions as F

from saleswh.catalog import query
from saleswh.catalog.sql import FLAT, with_
from saleswh.functions import in_order, money_sum
from saleswh.plans import reports, star, tables
from saleswh.sources import prepare
from saleswh.storage import new_path, stage

FLAT_SQL = with_(FLAT)
COUNTRY_SQL = (
    FLAT_SQL + "SELECT country, CAST(sum(sales) AS DECIMAL(22,2)) AS total_sales FROM flat "
    "GROUP BY country ORDER BY total_sales DESC, country"
)
LINES_SQL = (
    FLAT_SQL + "SELECT product_line, CAST(sum(sales) AS DECIMAL(22,2)) AS total_sales FROM flat "
    "GROUP BY product_line ORDER BY total_sales DESC, product_line LIMIT 10"
)
MONTH_SQL = (
    FLAT_SQL + "SELECT year_id, month_id, month_name, CAST(sum(sales) AS DECIMAL(22,2)) AS total_sales "
    "FROM flat GROUP BY year_id, month_id, month_name ORDER BY year_id, month_id"
)


@query(COUNTRY_SQL)
def revenue_by_country(spark, d):
    return reports.revenue_by_country(tables.sales_star(spark, d))


@query(LINES_SQL)
def top_product_lines(spark, d):
    return reports.top_product_lines(tables.sales_star(spark, d))


@query(MONTH_SQL)
def monthly_sales(spark, d):
    return reports.monthly_sales(tables.sales_star(spark, d))


@query(COUNTRY_SQL)
def revenue_by_country_flat(spark, d):
    return reports.revenue_by_country_flat(tables.sales_flat(spark, d, ["country", "sales"]))


@query(LINES_SQL)
def top_product_lines_flat(spark, d):
    return reports.top_product_lines_flat(tables.sales_flat(spark, d, ["product_line", "sales"]))


@query(MONTH_SQL)
def monthly_sales_flat(spark, d):
    cols = ["year_id", "month_id", "month_name", "sales"]
    return reports.monthly_sales_flat(tables.sales_flat(spark, d, cols))


@query(COUNTRY_SQL)
def revenue_by_country_prepared(spark, d):
    return reports.revenue_by_country_flat(prepare(tables.sales_flat(spark, d, ["country", "sales"])))


@query(
    FLAT_SQL + "SELECT country, CAST(sum(sales) AS DECIMAL(22,2)) AS total_sales FROM flat "
    "GROUP BY country ORDER BY total_sales DESC, country"
)
def sales_data_view(spark, d):
    """The report as SQL text on the registered views."""
    reports.register_views(spark, tables.sales_star(spark, d))
    return spark.sql(
        "SELECT COUNTRY AS country, CAST(SUM(SALES) AS DECIMAL(22,2)) AS total_sales FROM sales_data "
        "GROUP BY COUNTRY ORDER BY total_sales DESC, country"
    )


@query(FLAT_SQL + "SELECT * FROM flat")
def sales_flat(spark, d):
    return tables.sales_flat(spark, d)


@query(FLAT_SQL + "SELECT order_date, order_number, order_line_number, product_code, country, sales FROM flat "
       "ORDER BY order_date, order_number, order_line_number")
def sales_listing(spark, d):
    """The wide frame as a listing by order date."""
    cols = ["order_date", "order_number", "order_line_number", "product_code", "country", "sales"]
    return tables.sales_flat(spark, d, cols).orderBy(
        *in_order("order_date", "order_number", "order_line_number")
    )


# --- building the star from the flat sales file

PRODUCT_CTE = """
dim_product AS (
  SELECT row_number() OVER (ORDER BY product_code, product_line, msrp) AS product_key, *
  FROM (SELECT DISTINCT product_code, product_line, msrp FROM flat)
)"""
CUSTOMER_CTE = """
dim_customer AS (
  SELECT row_number() OVER (ORDER BY customer_name, city NULLS LAST, state NULLS LAST, country, territory)
           AS customer_key, customer_name, CAST(NULL AS VARCHAR) AS phone, city, state, country, territory
  FROM (SELECT DISTINCT customer_name, city, state, country, territory FROM flat)
)"""
DATE_CTE = """
dim_date AS (
  SELECT row_number() OVER (ORDER BY order_date, qtr_id, month_id, year_id) AS date_key, order_date,
         qtr_id, month_id, year_id, monthname(order_date) AS month_name,
         CAST(day(order_date) AS INTEGER) AS day, dayname(order_date) AS day_of_week
  FROM (SELECT DISTINCT order_date, qtr_id, month_id, year_id FROM flat)
)"""
FACT_CTE = """
fact_sales AS (
  SELECT order_number, order_line_number, product_key, customer_key, date_key,
         quantity_ordered, price_each, sales, deal_size
  FROM flat f
  JOIN dim_product p ON p.product_code = f.product_code AND p.product_line = f.product_line AND p.msrp = f.msrp
  JOIN dim_customer c ON c.customer_name = f.customer_name AND c.country = f.country
   AND c.territory = f.territory AND c.state IS NOT DISTINCT FROM f.state
   AND c.city IS NOT DISTINCT FROM f.city
  JOIN dim_date d ON d.order_date = f.order_date
)"""


@query(with_(FLAT, PRODUCT_CTE) + "SELECT * FROM dim_product")
def dim_product(spark, d):
    return star.build_dim_product(tables.sales_file(spark, d))


@query(
    with_(FLAT, CUSTOMER_CTE)
    + "SELECT customer_key, customer_name, phone, city, state, country, territory FROM dim_customer"
)
def dim_customer(spark, d):
    return star.build_dim_customer(tables.sales_file(spark, d)).select(
        "customer_key", "customer_name", "phone", "city", "state", "country", "territory"
    )


@query(with_(FLAT, DATE_CTE) + "SELECT * FROM dim_date")
def dim_date(spark, d):
    return star.build_dim_date(tables.sales_file(spark, d))


@query(with_(FLAT, PRODUCT_CTE, CUSTOMER_CTE, DATE_CTE, FACT_CTE) + "SELECT * FROM fact_sales")
def fact_sales(spark, d):
    flat = stage(tables.sales_file(spark, d), "sales-file")  # read four times
    dims = star.build_dim_product(flat), star.build_dim_customer(flat), star.build_dim_date(flat)
    return star.build_fact(flat, *dims, covered=True)


@query(
    FLAT_SQL + "SELECT country, product_line, year_id, CAST(sum(sales) AS DECIMAL(22,2)) AS total_sales, "
    "CAST(count(*) AS BIGINT) AS n FROM flat GROUP BY country, product_line, year_id"
)
def star_round_trip(spark, d):
    """Flat file to written star and back to the wide frame, summed."""
    built = star.run_star_etl(tables.sales_file(spark, d), new_path(spark, "star"))
    wide = built.flat(["country", "product_line", "year_id", "sales"])
    return wide.groupBy("country", "product_line", "year_id").agg(
        money_sum("sales").alias("total_sales"), F.count("*").alias("n")
    )
