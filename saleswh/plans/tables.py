"""The warehouse's inputs expressed on the benchmark tables (region .. lineitem, events)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from saleswh.functions import day_name, month_id, month_name, qtr_id, to_money, year_id
from saleswh.operators.scd2 import scd2_init
from saleswh.plans.star import FLAT_COLUMNS, Star
from saleswh.schemas import SCHEMAS

# first day of the order history, and the day some customers move
HISTORY_START = "1995-01-01"
MOVE_DAY = "1998-01-01"


# schemas of tables read so far, so that only the first read of a table looks into its files
_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _deal_size(sales):
    return F.when(sales < 30000, "Small").when(sales < 70000, "Medium").otherwise("Large")


def _lines(spark, sf_dir) -> DataFrame:
    """Line items in fact column names."""
    li = table(spark, sf_dir, "lineitem")
    sales = to_money("l_extendedprice")
    return li.select(
        F.col("l_orderkey").alias("order_number"),
        F.col("l_linenumber").alias("order_line_number"),
        F.col("l_partkey").alias("product_key"),
        F.col("l_quantity").cast("int").alias("quantity_ordered"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price_each"),
        sales.alias("sales"),
        _deal_size(sales).alias("deal_size"),
    )


def _products(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_key"),
        F.col("p_partkey").cast("string").alias("product_code"),
        F.col("p_type").alias("product_line"),
        to_money("p_retailprice").alias("msrp"),
    )


def _customers(spark, sf_dir, columns: Sequence[str] = FLAT_COLUMNS["customer"]) -> DataFrame:
    """Customers with the wanted columns; places only filter when none of theirs is wanted."""
    out = table(spark, sf_dir, "customer")
    exprs = {
        "customer_name": F.col("c_name"),
        "city": F.lit(None).cast("string"),
        "state": F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")),
        "country": F.col("n_name"),
        "territory": F.col("r_name"),
    }
    far = "territory" in columns
    near = far or "country" in columns
    region = table(spark, sf_dir, "region")
    places = table(spark, sf_dir, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"), "inner" if far else "left_semi")
    out = out.join(places, F.col("c_nationkey") == F.col("n_nationkey"), "inner" if near else "left_semi")
    return out.select(F.col("c_custkey").alias("customer_key"), *[exprs[c].alias(c) for c in columns])


def _calendar(d) -> dict:
    return {
        "order_date": F.to_date(d),
        "year_id": year_id(d),
        "month_id": month_id(d),
        "month_name": month_name(d),
        "qtr_id": qtr_id(d),
        "day_of_week": day_name(d),
    }


def sales_star(spark: SparkSession, sf_dir: str) -> Star:
    """The star over the benchmark tables; the order date serves as the date key."""
    orders = table(spark, sf_dir, "orders")
    heads = orders.select(
        F.col("o_orderkey").alias("order_number"),
        F.col("o_custkey").alias("customer_key"),
        F.col("o_orderdate").alias("date_key"),
    )
    fact = _lines(spark, sf_dir).join(heads, "order_number")
    date = orders.select(F.col("o_orderdate").alias("date_key")).distinct()
    return Star(
        fact,
        _products(spark, sf_dir),
        _customers(spark, sf_dir),
        date.select("date_key", *[e.alias(c) for c, e in _calendar(F.col("date_key")).items()]),
    )


def sales_flat(spark: SparkSession, sf_dir: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The wide sales frame over the benchmark tables, all twenty columns or the chosen ones.

    Customers and places are joined to the order heads first, so line items, by far the
    largest table, are shuffled by order at most once for them. As in Star.flat, tables that own no
    chosen column only filter.
    """
    wanted = list(columns or [c for cols in FLAT_COLUMNS.values() for c in cols])
    out = _lines(spark, sf_dir)
    dates = [c for c in FLAT_COLUMNS["date"] if c in wanted]
    people = [c for c in FLAT_COLUMNS["customer"] if c in wanted]
    goods = [c for c in FLAT_COLUMNS["product"] if c in wanted]
    days = _calendar(F.col("o_orderdate"))
    customers = _customers(spark, sf_dir, people)
    heads = table(spark, sf_dir, "orders")
    heads = heads.join(customers, F.col("o_custkey") == F.col("customer_key"), "inner" if people else "left_semi")
    heads = heads.select(F.col("o_orderkey").alias("order_number"), *[days[c].alias(c) for c in dates], *people)
    out = out.join(heads, "order_number", "inner" if dates or people else "left_semi")
    out = out.join(_products(spark, sf_dir).select("product_key", *goods), "product_key", "inner" if goods else "left_semi")
    return out.select(*wanted)


def sales_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark tables in the layout of the flat sales file."""
    flat = sales_flat(spark, sf_dir)
    names = {
        "ORDERNUMBER": "order_number", "QUANTITYORDERED": "quantity_ordered", "PRICEEACH": "price_each",
        "ORDERLINENUMBER": "order_line_number", "SALES": "sales", "ORDERDATE": "order_date",
        "QTR_ID": "qtr_id", "MONTH_ID": "month_id", "YEAR_ID": "year_id",
        "PRODUCTLINE": "product_line", "MSRP": "msrp", "PRODUCTCODE": "product_code",
        "CUSTOMERNAME": "customer_name", "CITY": "city", "STATE": "state", "COUNTRY": "country",
        "TERRITORY": "territory", "DEALSIZE": "deal_size",
    }
    return flat.select(
        *[
            (F.col(names[c]) if c in names else F.lit(None).cast("string")).alias(c)
            for c in SCHEMAS["sales_file"].names
        ]
    )


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


def customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned customers: those of the BUILDING segment moved once."""
    city = F.concat(F.lit("CITY_"), F.col("c_nationkey").cast("string"))
    moved_to = F.concat(F.lit("CITY_"), (F.col("c_nationkey") + 1).cast("string"))
    moved = F.col("c_mktsegment") == "BUILDING"
    start, move, never = _ntz(HISTORY_START), _ntz(MOVE_DAY), F.lit(None).cast("timestamp_ntz")

    def version(place, valid_from, valid_to):
        return F.struct(place.alias("city"), valid_from.alias("valid_from"), valid_to.alias("valid_to"))

    versions = F.when(
        moved, F.array(version(city, start, move), version(moved_to, move, never))
    ).otherwise(F.array(version(city, start, never)))
    return (
        table(spark, sf_dir, "customer")
        .select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"), F.inline(versions))
        .withColumn("is_current", F.col("valid_to").isNull())
    )


def price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned products: four list prices, one more every two years."""
    step = F.col("step")
    steps = table(spark, sf_dir, "part").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("step")
    )

    def new_year(year):
        return F.make_date(year, F.lit(1), F.lit(1)).cast("timestamp_ntz")

    return steps.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        (F.col("p_retailprice") + 10 * step).cast("decimal(10,2)").alias("price"),
        new_year(1995 + 2 * step).alias("valid_from"),
        F.when(step < 3, new_year(1997 + 2 * step)).alias("valid_to"),
        (step == 3).alias("is_current"),
    )


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order that has lines: its customer, first product, date and amount."""
    first_product = (
        table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_partkey").alias("product_id"))
    )
    orders = table(spark, sf_dir, "orders")
    return orders.join(first_product, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        "product_id",
        F.col("o_orderdate").alias("order_date"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("amount"),
    )


def priority_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a priority attribute, one open version each, ids in key order."""
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.lit("3-MEDIUM").alias("priority"),
    )
    return scd2_init(rows, "customer_id", _ntz(HISTORY_START))


def priority_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order reports its customer's priority at order time."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("changed_at"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_orderkey").alias("change_no"),
    )
