"""Sources and sinks: whole tables written to the shared folder and read back."""

import uuid
from datetime import datetime, timezone

from pyspark.sql import functions as F

from saleswh import sources
from saleswh.catalog import query
from saleswh.catalog.sql import FLAT, with_
from saleswh.functions import SALES_FILE_DATE, now, set_size, to_mb
from saleswh.operators.maintain import replicate
from saleswh.plans import reports
from saleswh.plans.tables import sales_file, sales_flat, table
from saleswh.schemas import create_table, make_schema
from saleswh.storage import new_path


@query("SELECT CAST(p_partkey AS INTEGER) AS product_id, p_name AS name, p_retailprice AS price FROM part")
def csv_round_trip(spark, d):
    path = new_path(spark, "products-csv")
    part = table(spark, d, "part").select(
        F.col("p_partkey").cast("int").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").alias("price"),
    )
    part.write.option("header", True).csv(path)
    return sources.read_products(spark, path)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def csv_inferred_round_trip(spark, d):
    path = new_path(spark, "customers-csv")
    table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal").write.option("header", True).csv(path)
    return sources.read_csv_inferred(spark, path).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query(
    with_(FLAT) + "SELECT CAST(order_number AS INTEGER) AS ordernumber, sales, CAST(order_date AS TIMESTAMP) AS orderdate, "
    "customer_name || ' é' AS customername, state, product_code AS productcode FROM flat"
)
def sales_csv_round_trip(spark, d):
    """The flat sales file in latin-1, dates as text, NA for missing."""
    path = new_path(spark, "sales-csv")
    rows = sales_file(spark, d).withColumns(
        {
            "ORDERDATE": F.date_format("ORDERDATE", SALES_FILE_DATE),
            "CUSTOMERNAME": F.concat(F.col("CUSTOMERNAME"), F.lit(" é")),
            "PRICEEACH": F.round("PRICEEACH", 2),
        }
    )
    rows.write.option("header", True).option("encoding", "ISO-8859-1").option("nullValue", "NA").csv(path)
    back = sources.read_sales_csv(spark, path)
    return back.select(
        F.col("ORDERNUMBER").alias("ordernumber"),
        F.col("SALES").alias("sales"),
        F.col("ORDERDATE").cast("timestamp_ntz").alias("orderdate"),
        F.col("CUSTOMERNAME").alias("customername"),
        F.col("STATE").alias("state"),
        F.col("PRODUCTCODE").alias("productcode"),
    )


@query(
    "SELECT c_custkey, c_name, NULLIF(c_mktsegment, 'BUILDING') AS segment, c_acctbal FROM customer"
)
def copy_text_round_trip(spark, d):
    r"""Customers as tab-delimited dump lines with \N for null."""
    path = new_path(spark, "customers-copy")
    rows = table(spark, d, "customer").select(
        "c_custkey", "c_name", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), "c_acctbal"
    )
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in rows.columns]
    rows.select(F.concat_ws("\t", *fields).alias("value")).write.text(path)
    schema = make_schema(c_custkey="long", c_name="string", segment="string", c_acctbal="double")
    return sources.read_copy_text(spark, path, schema)


@query(
    "SELECT p_partkey AS product_id, chr(92) || 'N ' || p_name || chr(9) || 'é' AS name, p_type AS kind FROM part "
)
def dump_round_trip(spark, d):
    r"""One table of a dump with two, its blocks interleaved and written as parts; names hold escapes, a row looks like a header."""
    path = new_path(spark, "dump")
    part, customer = table(spark, d, "part"), table(spark, d, "customer")
    name = F.concat(F.lit(r"\\N "), F.col("p_name"), F.lit(r"\t\303\xa9"))
    goods = part.select(
        (F.col("p_partkey") % 2 * 2).alias("block"), F.lit(1).alias("line"),
        F.concat_ws("\t", "p_type", name, F.col("p_partkey").cast("string")).alias("value"),
    )
    people = customer.select(F.lit(1).alias("block"), F.lit(1).alias("line"), F.concat_ws("\t", "c_name", "c_mktsegment").alias("value"))
    odd, end = "COPY public.products (kind, name, product_id) FROM stdin;", r"\."
    edges = [
        (-1, 0, "-- a dump"), (0, 0, odd), (0, 2, end), (1, 0, "COPY public.customers (name, segment) FROM stdin;"), (1, 1, odd), (1, 2, end),
        (2, 0, odd), (2, 2, end), (3, 0, "left over\tof\t9"),
    ]
    lines = goods.unionAll(people).unionAll(spark.createDataFrame(edges, "block int, line int, value string"))
    lines.repartitionByRange(4, "block", "line", "value").sortWithinPartitions("block", "line", "value").select("value").write.text(path)
    schema = make_schema(product_id="long", name="string", kind="string")
    return sources.read_dump(spark, path, "products", schema, joined=True)


@query(with_(FLAT) + """SELECT CAST(order_number AS INTEGER) AS ordernumber, sales, CAST(order_date AS TIMESTAMP) AS orderdate,
    'The "' || customer_name || '", Shop' AS customername, state, product_code AS productcode, msrp AS priceeach,
    quantity_ordered AS quantityordered, order_line_number AS orderlinenumber, qtr_id, month_id, year_id, product_line AS productline, msrp, country,
    territory, deal_size AS dealsize, CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS phone, CAST(NULL AS VARCHAR) AS addressline1,
    CAST(NULL AS VARCHAR) AS addressline2, CAST(NULL AS VARCHAR) AS postalcode, CAST(NULL AS VARCHAR) AS contactlastname,
    CAST(NULL AS VARCHAR) AS contactfirstname FROM flat""")
def sales_csv_quoted(spark, d):
    """All 24 columns of the flat sales file, names with quotes and commas."""
    path = new_path(spark, "sales-csv-quoted")
    rows = sales_file(spark, d).withColumns(
        {
            "ORDERDATE": F.date_format("ORDERDATE", SALES_FILE_DATE),
            "CUSTOMERNAME": F.concat(F.lit('The "'), F.col("CUSTOMERNAME"), F.lit('", Shop')),
            "PRICEEACH": F.col("MSRP"),
        }
    )
    rows.write.option("header", True).option("encoding", "ISO-8859-1").option("nullValue", "NA").option("escape", '"').csv(path)
    back = sources.read_sales_csv(spark, path)
    return back.toDF(*[c.lower() for c in back.columns]).withColumn("orderdate", F.col("ORDERDATE").cast("timestamp_ntz"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders UNION ALL SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def parquet_round_trip(spark, d):
    """Orders twice over, written once; a second write to the same path is skipped."""
    path = new_path(spark, "scaled")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    sources.write_once(replicate(orders, 2), path)
    sources.write_once(orders, path)
    return sources.read_scaled(spark, path)


@query(
    "SELECT CAST(NULL AS BIGINT) AS product_key, CAST(p_partkey AS VARCHAR) AS product_code, p_type AS product_line, "
    "CAST(p_retailprice AS DECIMAL(12,2)) AS msrp FROM part UNION ALL "
    "SELECT NULL, CAST(p_partkey AS VARCHAR), p_type, NULL FROM part"
)
def append_round_trip(spark, d):
    """A typed table created empty, then appended to with chosen columns, by name."""
    name = f"dim_product_{uuid.uuid4().hex}"
    create_table(spark, name, new_path(spark, name), like="dim_product")
    part = table(spark, d, "part").select(
        F.col("p_type").alias("product_line"),
        F.col("p_partkey").cast("string").alias("product_code"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("msrp"),
    )
    sources.append_table(part, name)
    sources.append_table(part, name, ["product_code", "product_line"])
    return spark.table(name)


@query(
    with_(FLAT) + "SELECT country, CAST(sum(sales) AS DECIMAL(22,2)) AS total_sales FROM flat "
    "GROUP BY country ORDER BY total_sales DESC, country"
)
def table_as_select(spark, d):
    name = f"fact_sales_scaled_{uuid.uuid4().hex}"
    flat = sales_flat(spark, d, ["country", "sales"])
    return reports.revenue_by_country_flat(sources.ctas(name, flat, new_path(spark, name)))


@query(
    with_(FLAT) + "SELECT country, CAST(sum(sales) AS DECIMAL(22,2)) AS total_sales FROM flat GROUP BY country"
)
def report_round_trip(spark, d):
    """A report written as one CSV file and read back."""
    path = new_path(spark, "report")
    sources.write_report(reports.revenue_by_country_flat(sales_flat(spark, d, ["country", "sales"])), path)
    return sources.read_typed_csv(spark, path, make_schema(country="string", total_sales="decimal(22,2)"))


@query(
    "SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS rows, TRUE AS has_size, TRUE AS as_listed FROM orders GROUP BY o_orderpriority"
)
def storage_size(spark, d):
    """Rows and size of the orders written per priority; files and bytes must be those of a listing of the folder."""
    path = new_path(spark, "sized")
    table(spark, d, "orders").write.partitionBy("o_orderpriority").parquet(path)
    parts = sources.storage_footprint(spark, path, ["o_orderpriority"])
    whole = sources.storage_footprint(spark, path).select("files", F.round(F.col("bytes") / 1048576, 6).alias("mb")).collect()[0]
    listed = sources.dataset_size_mb(spark, path).select("files", F.round("size_mb", 6).alias("mb")).collect()[0]
    return parts.select("o_orderpriority", "rows", (F.col("bytes") > 0).alias("has_size"), F.lit(whole == listed).alias("as_listed"))


@query("SELECT c_custkey AS id, c_name AS name, TRUE AS clock_runs, 2 AS size, CAST(c_custkey AS DOUBLE) / 1048576 AS mb FROM customer")
def scalar_helpers(spark, d):
    """Set size, bytes as megabytes, and the time of the query, which does not lie before the clock's."""
    rows = table(spark, d, "customer")
    before = datetime.now(timezone.utc).replace(tzinfo=None)
    return rows.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        (now().cast("timestamp_ntz") >= F.lit(before)).alias("clock_runs"),
        set_size(F.array_distinct(F.array(F.lit("a"), F.lit("b"), F.lit("a")))).alias("size"), to_mb("c_custkey").alias("mb"),
    )
