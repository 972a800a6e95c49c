"""Keyed upsert: one document per key, and the bucketed collection."""

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from saleswh.operators import documents
from saleswh.sources import write_once
from saleswh.storage import new_path

KINDS = "id string, n int, no int"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def twice(spark):
    return spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 3, 1)], KINDS)


def test_repeated_and_missing_keys_are_errors(spark, twice, timeline):
    from saleswh.operators.asof import as_of_orders

    target = spark.createDataFrame([("a", 0)], "id string, n int")
    with pytest.raises(PySparkException, match="several documents of key a"):
        documents.upsert(target, twice, "id").collect()
    with pytest.raises(PySparkException, match="no key"):
        documents.upsert(target, spark.createDataFrame([(None, 1)], "id string, n int"), "id").collect()
    with pytest.raises(PySparkException, match="several documents of key a"):
        documents.upsert_partitions(twice, new_path(spark, "p"), "id", "no")
    view = as_of_orders(timeline.orders, timeline.customers, timeline.products)
    base = new_path(spark, "collection")
    with pytest.raises(PySparkException, match="several documents of key O"):
        documents.publish_orders(view.unionAll(view), base)
    raised = view.withColumn("amount", (F.col("amount") + 1).cast("decimal(10,2)"))
    documents.publish_orders(view.unionAll(raised), base, last_by="amount")
    from saleswh.sources import read_latest

    assert rows(read_latest(spark, base).select("order_id", "amount"))[0] == ("O1", 1001.0)


def test_last_of_equal_orders_is_the_same_each_time(spark):
    source = [("a", i, 1) for i in range(50)]
    for order in (source, source[::-1]):
        got = documents.one_per_key(spark.createDataFrame(order, KINDS).repartition(7), "id", "no")
        assert rows(got) == [("a", 49, 1)]


def test_collection_takes_batches(spark, twice):
    held = documents.Collection(new_path(spark, "bucketed"), "id", 4)
    assert held.read(spark) is None
    held.upsert(spark.createDataFrame([(f"k{i}", i, "old") for i in range(40)], "id string, n int, extra string"))
    with pytest.raises(PySparkException, match="several documents of key a"):
        held.upsert(twice)
    assert held.read(spark).count() == 40  # a failed batch changes nothing
    first = held.read(spark)
    held.upsert(twice, last_by="no")
    held.upsert(spark.createDataFrame([("k3", None, 7)], KINDS))
    got = {r.id: r for r in held.read(spark).collect()}
    assert len(got) == 42 and got["a"].n == 2 and got["a"].extra is None
    assert (got["k3"].n, got["k3"].extra, got["k3"].no) == (None, "old", 7) and got["k4"].n == 4
    assert first.count() == 40  # the earlier version is still there


@pytest.mark.parametrize("partitions", [2, 4, 40])
def test_only_the_batch_is_shuffled(spark, partitions):
    held = documents.Collection(new_path(spark, "bucketed"), "id", 8)
    held.upsert(spark.range(1000).select(F.col("id").cast("string").alias("id"), F.col("id").alias("n")))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        batch = documents.one_per_key(spark.range(500, 1500).select(F.col("id").cast("string").alias("id"), F.lit(-1).alias("n")).repartition(8, "id"), "id")
        plan = plan_of(documents._merged(held.read(spark), batch, "id"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan and "Bucketed: true" in plan


def test_each_bucket_is_one_file(spark, tmp_path):
    held = documents.Collection(str(tmp_path / "c"), "id", 4)
    path = held.upsert(spark.range(100).select(F.col("id").cast("string").alias("id")))
    names = [f.name for f in (tmp_path / "c").glob("v*/part-*.parquet")]
    assert path.startswith(str(tmp_path)) or path.startswith("file:")
    assert len(names) == 4 and len({n.rsplit("_", 1)[1] for n in names}) == 4


def test_write_once_wants_a_complete_dataset(spark, tmp_path):
    path = tmp_path / "once"
    write_once(spark.range(3), str(path))
    assert write_once(spark.range(9), str(path)).count() == 3
    (path / "_SUCCESS").unlink()
    next(path.glob("part-*.parquet")).unlink()
    assert write_once(spark.range(9), str(path)).count() == 9
    (tmp_path / "mine").mkdir()
    (tmp_path / "mine" / "notes.txt").write_text("x")
    with pytest.raises(ValueError, match="notes.txt"):
        write_once(spark.range(3), str(tmp_path / "mine"))
    assert (tmp_path / "mine" / "notes.txt").exists()
