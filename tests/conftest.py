import os
import sys
from datetime import datetime
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from saleswh.operators import scd2  # noqa: E402
from saleswh.schemas import SCHEMAS  # noqa: E402
from saleswh.storage import build_session, release, stage  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release(session)
    session.stop()


def rows(df, *order):
    """Collected rows as tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


def at(minute: int) -> datetime:
    """A time on the day of the order timeline; the session zone is UTC."""
    return datetime(2025, 10, 7, 17, minute)


class Timeline:
    """The worked example of versioned customers, products and orders."""

    def __init__(self, spark):
        # The example's loads, changes and orders.
        customers = spark.createDataFrame(
            [
                ("C1", "Alice", "alice@icloud.com", "New York"),
                ("C2", "Bob", "bob@icloud.com", "Boston"),
            ],
            "customer_id string, name string, email string, city string",
        )
        products = spark.createDataFrame(
            [
                ("P1", "Laptop", "Computing Devices", Decimal("1000.00")),
                ("P2", "Phone", "Mobile Devices", Decimal("500.00")),
            ],
            "product_id string, name string, category string, price decimal(10,2)",
        )
        self.city_changes = spark.createDataFrame(
            [("C1", "Chicago", at(6)), ("C2", "Calgary", at(15))],
            "customer_id string, city string, changed_at timestamp",
        )
        self.price_changes = spark.createDataFrame(
            [("P1", Decimal("900.00"), at(10))],
            "product_id string, price decimal(10,2), changed_at timestamp",
        )
        self.orders = spark.createDataFrame(
            [
                ("O1", "C1", "P1", at(5), Decimal("1000.00")),
                ("O2", "C1", "P1", at(15), Decimal("850.00")),
                ("O3", "C2", "P2", at(15), Decimal("500.00")),
                ("O4", "C1", "P1", at(15), Decimal("900.00")),
            ],
            SCHEMAS["fact_orders"],
        )
        from pyspark.sql import functions as F

        start = F.lit("2025-10-07 17:00:00").cast("timestamp")
        self.first_customers = scd2.scd2_init(customers, "customer_id", start)
        self.first_products = scd2.scd2_init(products, "product_id", start)
        self.customers = stage(scd2.scd2_apply(self.first_customers, self.city_changes, "customer_id"))
        self.products = stage(scd2.scd2_apply(self.first_products, self.price_changes, "product_id"))


@pytest.fixture(scope="session")
def timeline(spark):
    return Timeline(spark)
