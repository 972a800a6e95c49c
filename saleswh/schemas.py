"""Typed tables of the four models: campus, products, versioned orders, sales star."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType


def make_schema(**fields: str) -> StructType:
    """Nullable columns by Spark's short type names."""
    schema = StructType()
    for name, dtype in fields.items():
        schema.add(name, dtype)
    return schema


SCHEMAS: dict[str, StructType] = {
    "students": make_schema(
        id="long",
        name="string",
        age="integer",
        major="string",
        email="string",
    ),
    "enrollments": make_schema(
        enroll_id="long",
        student_id="integer",
        course="string",
    ),
    "products": make_schema(
        product_id="integer",
        name="string",
        price="double",
    ),
    "dim_customers": make_schema(
        id="long",
        customer_id="string",
        name="string",
        email="string",
        city="string",
        valid_from="timestamp",
        valid_to="timestamp",
        is_current="boolean",
    ),
    "dim_products": make_schema(
        id="long",
        product_id="string",
        name="string",
        category="string",
        price="decimal(10,2)",
        valid_from="timestamp",
        valid_to="timestamp",
        is_current="boolean",
    ),
    "fact_orders": make_schema(
        order_id="string",
        customer_id="string",
        product_id="string",
        order_date="timestamp",
        amount="decimal(10,2)",
    ),
    "orders_summary": make_schema(
        order_id="string",
        order_date="timestamp",
        customer_id="string",
        customer_name="string",
        customer_city="string",
        product_id="string",
        product_name="string",
        product_price="double",
        amount="double",
    ),
    "dim_product": make_schema(
        product_key="long",
        product_code="string",
        product_line="string",
        msrp="decimal(12,2)",
    ),
    "dim_customer": make_schema(
        customer_key="long",
        customer_name="string",
        contact_first_name="string",
        contact_last_name="string",
        phone="string",
        address_line1="string",
        address_line2="string",
        city="string",
        state="string",
        postal_code="string",
        country="string",
        territory="string",
    ),
    "dim_date": make_schema(
        date_key="long",
        order_date="date",
        qtr_id="integer",
        month_id="integer",
        year_id="integer",
        month_name="string",
        day="integer",
        day_of_week="string",
    ),
    "fact_sales": make_schema(
        order_number="integer",
        order_line_number="integer",
        product_key="long",
        customer_key="long",
        date_key="long",
        quantity_ordered="integer",
        price_each="decimal(12,2)",
        sales="decimal(12,2)",
        deal_size="string",
    ),
    # columns of the flat sales file that the star is built from
    "sales_file": make_schema(
        ORDERNUMBER="integer",
        QUANTITYORDERED="integer",
        PRICEEACH="decimal(12,2)",
        ORDERLINENUMBER="integer",
        SALES="decimal(12,2)",
        ORDERDATE="timestamp",
        QTR_ID="integer",
        MONTH_ID="integer",
        YEAR_ID="integer",
        PRODUCTLINE="string",
        MSRP="decimal(12,2)",
        PRODUCTCODE="string",
        CUSTOMERNAME="string",
        PHONE="string",
        ADDRESSLINE1="string",
        ADDRESSLINE2="string",
        CITY="string",
        STATE="string",
        POSTALCODE="string",
        COUNTRY="string",
        TERRITORY="string",
        CONTACTLASTNAME="string",
        CONTACTFIRSTNAME="string",
        DEALSIZE="string",
    ),
}

# Column names of the flat sales file and of the star tables.
PRODUCT_COLUMNS = {
    "PRODUCTCODE": "product_code",
    "PRODUCTLINE": "product_line",
    "MSRP": "msrp",
}
CUSTOMER_COLUMNS = {
    "CUSTOMERNAME": "customer_name",
    "CONTACTFIRSTNAME": "contact_first_name",
    "CONTACTLASTNAME": "contact_last_name",
    "PHONE": "phone",
    "ADDRESSLINE1": "address_line1",
    "ADDRESSLINE2": "address_line2",
    "CITY": "city",
    "STATE": "state",
    "POSTALCODE": "postal_code",
    "COUNTRY": "country",
    "TERRITORY": "territory",
}
DATE_COLUMNS = {
    "ORDERDATE": "order_date",
    "QTR_ID": "qtr_id",
    "MONTH_ID": "month_id",
    "YEAR_ID": "year_id",
}
FACT_COLUMNS = {
    "ORDERNUMBER": "order_number",
    "ORDERLINENUMBER": "order_line_number",
    "product_key": "product_key",
    "customer_key": "customer_key",
    "date_key": "date_key",
    "QUANTITYORDERED": "quantity_ordered",
    "PRICEEACH": "price_each",
    "SALES": "sales",
    "DEALSIZE": "deal_size",
}


def create_table(spark: SparkSession, name: str, path: str | None = None, like: str | None = None) -> None:
    """Create an empty typed table; ``like`` names the schema when it is not the table's own name."""
    writer = spark.createDataFrame([], SCHEMAS[like or name]).write
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
