"""The three benchmark reports, on the star and on the flat frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saleswh.functions import in_order, largest_first, money_sum
from saleswh.operators.relational import top_k
from saleswh.plans.star import Star


def _sales_by(star: Star, dim: str, attrs: list[str]) -> DataFrame:
    """Sales per dimension attribute.

    The fact is summed per surrogate key before the join: what is shuffled is one
    partial sum per key and task, and a key that owns a third of the fact is one row
    by then.
    """
    key = f"{dim}_key"
    per_key = star.fact.groupBy(key).agg(F.sum("sales").alias("_sales"))
    joined = per_key.join(getattr(star, dim).select(key, *attrs), key)
    return joined.groupBy(*attrs).agg(money_sum("_sales").alias("total_sales"))


def revenue_by_country(star: Star) -> DataFrame:
    return _sales_by(star, "customer", ["country"]).orderBy(*largest_first("total_sales", "country"))


def top_product_lines(star: Star, n: int = 10) -> DataFrame:
    return top_k(_sales_by(star, "product", ["product_line"]), "total_sales", "product_line", n)


def monthly_sales(star: Star) -> DataFrame:
    by_month = _sales_by(star, "date", ["year_id", "month_id", "month_name"])
    return by_month.orderBy(*in_order("year_id", "month_id"))


def revenue_by_country_flat(flat: DataFrame) -> DataFrame:
    totals = flat.groupBy("country").agg(money_sum("sales").alias("total_sales"))
    return totals.orderBy(*largest_first("total_sales", "country"))


def top_product_lines_flat(flat: DataFrame, n: int = 10) -> DataFrame:
    totals = flat.groupBy("product_line").agg(money_sum("sales").alias("total_sales"))
    return top_k(totals, "total_sales", "product_line", n)


def monthly_sales_flat(flat: DataFrame) -> DataFrame:
    by = ["year_id", "month_id", "month_name"]
    totals = flat.groupBy(*by).agg(money_sum("sales").alias("total_sales"))
    return totals.orderBy(*in_order("year_id", "month_id"))


def register_views(spark: SparkSession, star: Star, as_of: DataFrame | None = None) -> None:
    """Temp views for SQL users: the star, the flat ``sales_data`` and ``as_of_orders``."""
    star.fact.createOrReplaceTempView("fact_sales")
    star.product.createOrReplaceTempView("dim_product")
    star.customer.createOrReplaceTempView("dim_customer")
    star.date.createOrReplaceTempView("dim_date")
    star.flat().createOrReplaceTempView("sales_data")
    if as_of is not None:
        as_of.createOrReplaceTempView("as_of_orders")
