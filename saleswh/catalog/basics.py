"""Filters, aggregates, simple joins, table maintenance and constraint checks."""

from pyspark.sql import functions as F

from saleswh.catalog import query
from saleswh.functions import (
    day,
    day_name,
    iso_weekday,
    month_id,
    month_name,
    period_label,
    qtr_id,
    quarter_label,
    year_id,
)
from saleswh.operators import maintain, quality, relational
from saleswh.plans.tables import table


@query("SELECT * FROM nation")
def select_all(spark, d):
    return table(spark, d, "nation")


@query("SELECT p_name, p_retailprice FROM part")
def project_columns(spark, d):
    return table(spark, d, "part").select("p_name", "p_retailprice")


@query("SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_retailprice < 1000")
def filter_range(spark, d):
    return table(spark, d, "part").filter(F.col("p_retailprice") < 1000).select(
        "p_partkey", "p_name", "p_retailprice"
    )


@query("SELECT c_name FROM customer WHERE c_mktsegment = 'BUILDING'")
def filter_equal(spark, d):
    return table(spark, d, "customer").filter(F.col("c_mktsegment") == "BUILDING").select("c_name")


@query("SELECT CAST(count(*) AS BIGINT) AS n FROM customer")
def count_all(spark, d):
    return maintain.row_count(table(spark, d, "customer"))


@query("SELECT max(p_retailprice) AS maximum_price FROM part")
def max_price(spark, d):
    return table(spark, d, "part").agg(F.max("p_retailprice").alias("maximum_price"))


@query("SELECT round(avg(p_retailprice), 4) AS average_price FROM part")
def avg_price(spark, d):
    return table(spark, d, "part").agg(F.round(F.avg("p_retailprice"), 4).alias("average_price"))


@query("SELECT CAST(sum(CAST(p_retailprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS total FROM part")
def sum_price(spark, d):
    price = F.col("p_retailprice").cast("decimal(12,2)")
    return table(spark, d, "part").agg(F.sum(price).cast("decimal(22,2)").alias("total"))


@query("SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n FROM customer GROUP BY c_mktsegment")
def count_by_segment(spark, d):
    return relational.count_by(table(spark, d, "customer"), "c_mktsegment")


@query(
    "SELECT c_name, CAST(count(*) AS BIGINT) AS n FROM orders JOIN customer ON c_custkey = o_custkey "
    "GROUP BY c_name HAVING count(*) > 1"
)
def customers_having(spark, d):
    return relational.groups_having(
        table(spark, d, "orders"), "o_custkey", table(spark, d, "customer"), "c_custkey", "c_name", 1
    )


@query(
    "SELECT c_custkey, c_name, c_acctbal FROM customer "
    "WHERE c_acctbal = (SELECT min(c_acctbal) FROM customer)"
)
def rows_at_min(spark, d):
    customers = table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal")
    return relational.rows_at_min(customers, "c_acctbal")


@query(
    "SELECT c_name, o_orderkey, o_orderpriority FROM orders JOIN customer ON c_custkey = o_custkey "
    "ORDER BY c_name, o_orderkey"
)
def join_sorted(spark, d):
    orders, customers = table(spark, d, "orders"), table(spark, d, "customer")
    joined = orders.join(customers, F.col("c_custkey") == F.col("o_custkey"))
    return joined.select("c_name", "o_orderkey", "o_orderpriority").orderBy("c_name", "o_orderkey")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def order_by_desc(spark, d):
    return table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal").orderBy(
        F.col("c_acctbal").desc(), "c_custkey"
    )


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10")
def top_k_balance(spark, d):
    return relational.top_k(table(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", "c_custkey", 10)


@query("SELECT DISTINCT p_brand, p_type FROM part")
def distinct_columns(spark, d):
    return relational.distinct_dim(table(spark, d, "part"), ["p_brand", "p_type"])


@query("SELECT CAST(count(DISTINCT l_partkey) AS BIGINT) AS parts FROM lineitem")
def distinct_count(spark, d):
    return table(spark, d, "lineitem").agg(F.countDistinct("l_partkey").alias("parts"))


@query(
    "SELECT o_orderpriority AS most_common FROM orders GROUP BY o_orderpriority "
    "ORDER BY count(*) DESC, o_orderpriority LIMIT 1"
)
def mode_priority(spark, d):
    return relational.mode_value(table(spark, d, "orders"), "o_orderpriority").select(
        F.col("o_orderpriority").alias("most_common")
    )


@query(
    "SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS total "
    "FROM orders GROUP BY o_custkey ORDER BY total DESC, o_custkey LIMIT 1"
)
def top_buyer(spark, d):
    orders = table(spark, d, "orders").select(
        "o_custkey", F.col("o_totalprice").cast("decimal(12,2)").alias("price")
    )
    return relational.top_group(orders, "o_custkey", "price")


@query(
    """WITH firsts AS (
      SELECT o_custkey, o_orderpriority,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderpriority) AS rn
      FROM orders WHERE o_orderpriority <> '5-LOW')
    SELECT k.o_custkey, f.o_orderpriority AS first_priority
    FROM (SELECT DISTINCT o_custkey FROM orders) k
    LEFT JOIN (SELECT * FROM firsts WHERE rn = 1) f ON f.o_custkey = k.o_custkey"""
)
def first_by_customer(spark, d):
    """The first priority per customer, LOW counting as unknown (null) to be skipped."""
    orders = table(spark, d, "orders").select(
        "o_custkey", "o_orderdate", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("first_priority")
    )
    return relational.first_by(orders, ["o_custkey"], ["first_priority"], "o_orderdate")


@query(
    """WITH y AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year_id,
                         CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS total
                  FROM orders GROUP BY 1)
    SELECT year_id, total, lag(total) OVER (ORDER BY year_id) AS previous_total
    FROM y ORDER BY year_id DESC LIMIT 1"""
)
def previous_period(spark, d):
    price = F.col("o_totalprice").cast("decimal(12,2)")
    yearly = table(spark, d, "orders").groupBy(year_id("o_orderdate").alias("year_id")).agg(
        F.sum(price).cast("decimal(22,2)").alias("total")
    )
    return relational.previous_period(yearly, "year_id", "total")


@query(
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
              CAST(day(o_orderdate) AS INTEGER) AS day_no, CAST(month(o_orderdate) AS INTEGER) AS month_id,
              CAST(quarter(o_orderdate) AS INTEGER) AS qtr_id, CAST(year(o_orderdate) AS INTEGER) AS year_id,
              monthname(o_orderdate) AS month_name, dayname(o_orderdate) AS day_name,
              CAST(isodow(o_orderdate) AS INTEGER) AS weekday_no,
              year(o_orderdate) || '-' || monthname(o_orderdate) AS period,
              'Q' || quarter(o_orderdate) || ' ' || year(o_orderdate) AS quarter
       FROM orders"""
)
def date_parts(spark, d):
    t = "o_orderdate"
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.to_date(t).alias("order_date"),
        day(t).alias("day_no"),
        month_id(t).alias("month_id"),
        qtr_id(t).alias("qtr_id"),
        year_id(t).alias("year_id"),
        month_name(t).alias("month_name"),
        day_name(t).alias("day_name"),
        iso_weekday(t).alias("weekday_no"),
        period_label(year_id(t), month_name(t)).alias("period"),
        quarter_label(qtr_id(t), year_id(t)).alias("quarter"),
    )


@query(
    "SELECT p_partkey AS product_id, p_name AS name, p_type AS category, "
    "CAST(p_retailprice AS DECIMAL(10,2)) AS price FROM part"
)
def conform_columns(spark, d):
    return relational.conform(
        table(spark, d, "part"),
        {
            "product_id": "p_partkey",
            "name": "p_name",
            "category": "p_type",
            "price": F.col("p_retailprice").cast("decimal(10,2)"),
        },
    )


# --- maintenance


@query("SELECT *, CAST(NULL AS VARCHAR) AS email FROM customer")
def add_column(spark, d):
    return maintain.add_column(table(spark, d, "customer"), "email", "string")


@query(
    "SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN 'OVERDRAWN' ELSE c_mktsegment END AS c_mktsegment, "
    "c_acctbal FROM customer"
)
def update_where(spark, d):
    customers = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    return maintain.update_where(customers, F.col("c_acctbal") < 0, {"c_mktsegment": "OVERDRAWN"})


@query(
    "SELECT c_custkey, c_mktsegment FROM customer "
    "WHERE NOT coalesce(NULLIF(c_mktsegment, 'BUILDING') = 'MACHINERY', FALSE)"
)
def delete_where(spark, d):
    """Rows whose condition is null stay."""
    known = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return maintain.delete_where(
        table(spark, d, "customer").select("c_custkey", "c_mktsegment"), known == "MACHINERY"
    )


@query(
    "SELECT * FROM nation UNION ALL SELECT 901, 'ATLANTIS', NULL UNION ALL SELECT 902, 'LEMURIA', NULL"
)
def append_rows(spark, d):
    rows = [(901, "ATLANTIS"), (902, "LEMURIA")]
    return maintain.append_rows(table(spark, d, "nation"), rows, ["n_nationkey", "n_name"])


@query(
    "SELECT c_custkey, c_name, c_mktsegment FROM customer UNION ALL "
    "SELECT s_suppkey, s_name, 'SUPPLIER' FROM supplier WHERE s_acctbal > 0"
)
def append_select(spark, d):
    return maintain.append_select(
        table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment"),
        table(spark, d, "supplier"),
        F.col("s_acctbal") > 0,
        {"c_custkey": F.col("s_suppkey"), "c_name": F.col("s_name"), "c_mktsegment": "SUPPLIER"},
    )


@query(
    "SELECT c_custkey, coalesce(NULLIF(c_mktsegment, 'BUILDING'), 'UNKNOWN') AS segment, TRUE AS is_current "
    "FROM customer"
)
def apply_defaults(spark, d):
    rows = table(spark, d, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")
    )
    return maintain.apply_defaults(rows, {"segment": F.lit("UNKNOWN"), "is_current": F.lit(True)})


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem CROSS JOIN (SELECT unnest([1, 2, 3])) AS copies"
)
def replicate(spark, d):
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return maintain.replicate(lines, 3)


@query("SELECT CAST(count(*) * 2500 AS BIGINT) AS n FROM customer")
def replicate_in_blocks(spark, d):
    return maintain.row_count(maintain.replicate(table(spark, d, "customer").select("c_custkey"), 2500))


# --- constraints


@query(
    "SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n FROM lineitem "
    "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"
)
def check_unique(spark, d):
    return quality.check_unique(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """SELECT 'segment' AS column_name, CAST(count(*) AS BIGINT) AS nulls
       FROM customer WHERE NULLIF(c_mktsegment, 'BUILDING') IS NULL HAVING count(*) > 0
       UNION ALL SELECT 'name', CAST(count(*) AS BIGINT) FROM customer WHERE c_name IS NULL HAVING count(*) > 0"""
)
def check_not_null(spark, d):
    rows = table(spark, d, "customer").select(
        F.col("c_name").alias("name"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")
    )
    return quality.check_not_null(rows, ["name", "segment"])


@query(
    "SELECT l_partkey, CAST(count(*) AS BIGINT) AS n FROM lineitem WHERE NOT EXISTS "
    "(SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 10) GROUP BY l_partkey"
)
def check_fk(spark, d):
    """Lines whose part is not among the parts larger than size 10."""
    large = table(spark, d, "part").filter(F.col("p_size") > 10)
    return quality.check_fk(table(spark, d, "lineitem"), "l_partkey", large, "p_partkey")


@query("SELECT p_partkey, p_name FROM part WHERE length(p_name) > 10")
def check_max_len(spark, d):
    return quality.check_max_len(table(spark, d, "part").select("p_partkey", "p_name"), "p_name", 10)
