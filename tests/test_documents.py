from datetime import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from saleswh.operators import documents
from saleswh.operators.asof import as_of_orders
from saleswh.sources import read_latest
from saleswh.storage import new_path


@pytest.fixture(scope="module")
def view(timeline):
    return as_of_orders(timeline.orders, timeline.customers, timeline.products)


@pytest.fixture(scope="module")
def docs(view):
    return documents.to_document(view)


def test_money_becomes_double(docs):
    types = dict(docs.dtypes)
    assert types["product_price"] == types["amount"] == "double"


def test_aggregates(timeline, view, docs):
    assert rows(documents.distinct_cities_by_history(timeline.customers)) == [("C1", 2), ("C2", 2)]
    assert rows(documents.distinct_cities_by_customer(docs)) == [("C1", "Alice", 2), ("C2", "Bob", 1)]
    by_city = [(r[0], float(r[1])) for r in documents.sales_by_city(view).collect()]
    assert by_city == [("Calgary", 500.0), ("Chicago", 1750.0), ("New York", 1000.0)]
    descending = [tuple(r) for r in documents.amount_by_city_desc(docs).collect()]
    assert descending == [("Chicago", 1750.0), ("New York", 1000.0), ("Calgary", 500.0)]
    assert float(documents.price_gap_total(view).collect()[0][0]) == 50.0
    assert rows(documents.price_gap_total_doc(docs)) == [(50.0,)]


def test_empty_input(view, docs):
    assert rows(documents.price_gap_total(view.limit(0))) == [(None,)]
    assert rows(documents.price_gap_total_doc(docs.limit(0))) == []


def test_upsert_into_empty_and_again(docs):
    empty = docs.limit(0)
    once = documents.upsert(empty, docs, "order_id")
    assert rows(once.select(*docs.columns)) == rows(docs)
    assert rows(documents.upsert(once, docs, "order_id")) == rows(once)


def test_upsert_fields(spark):
    target = spark.createDataFrame(
        [("a", 1, "kept"), ("b", 2, "kept"), ("c", 3, None)], "id string, n int, extra string"
    )
    source = spark.createDataFrame([("b", None, 5), ("d", 4, 6)], "id string, n int, more int")
    got = documents.upsert(target, source, "id")
    assert got.columns == ["id", "n", "extra", "more"]
    assert rows(got) == [
        ("a", 1, "kept", None),
        ("b", None, "kept", 5),  # a null in the source overwrites
        ("c", 3, None, None),
        ("d", 4, None, 6),
    ]


def test_upsert_with_repeated_source_keys(spark):
    target = spark.createDataFrame([("a", 0)], "id string, n int")
    source = spark.createDataFrame([("a", 1, 1), ("a", None, 3), ("a", 2, 2)], "id string, n int, no int")
    assert rows(documents.upsert(target, source, "id", last_by="no")) == [("a", None, 3)]


def test_publish_versions(spark, view):
    base = new_path(spark, "collection")
    assert read_latest(spark, base) is None
    first, sent = documents.publish_orders(view.filter("order_id < 'O3'"), base)
    assert sent == 2 and read_latest(spark, base).count() == 2
    raised = view.withColumn("amount", (F.col("amount") + 1).cast("decimal(10,2)"))
    second, sent = documents.publish_orders(raised, base)
    assert sent == 4 and first != second
    latest = read_latest(spark, base)
    assert rows(latest.select("order_id", "amount")) == [("O1", 1001.0), ("O2", 851.0), ("O3", 501.0), ("O4", 901.0)]
    # the earlier version is still there for whoever reads it
    assert spark.read.parquet(first).count() == 2
    assert latest.filter(F.col("order_date") == F.lit(datetime(2025, 10, 7, 17, 5))).count() == 1


def test_upsert_touches_only_its_partitions(spark, docs, tmp_path):
    base = str(tmp_path / "by_city")
    documents.upsert_partitions(docs, base, "order_id", "customer_id")
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "by_city" / "customer_id=C1").glob("*.parquet")}
    change = docs.filter("customer_id = 'C2'").withColumn("amount", F.lit(None).cast("double"))
    new = change.withColumn("order_id", F.lit("O9"))
    documents.upsert_partitions(change.unionByName(new), base, "order_id", "customer_id")
    got = rows(spark.read.parquet(base).select("order_id", "customer_id", "amount"))
    assert got == [("O1", "C1", 1000.0), ("O2", "C1", 850.0), ("O3", "C2", None), ("O4", "C1", 900.0), ("O9", "C2", None)]
    assert {f: f.stat().st_mtime_ns for f in (tmp_path / "by_city" / "customer_id=C1").glob("*.parquet")} == before
