from pyspark.sql import Window
from pyspark.sql import functions as F

from saleswh.functions import in_order
from saleswh.operators.keys import assign_key, number_rows, running_total
from conftest import SF, rows


def test_numbers_equal_row_number(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keep many sort partitions
    try:
        df = spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderpriority")
        order = [F.col("o_custkey").desc(), "o_orderkey"]
        got = number_rows(df, order, "n", start=5)
        want = df.withColumn("n", (F.row_number().over(Window.orderBy(*order)) + 4).cast("bigint"))
        assert rows(got) == rows(want)
        total = running_total(df, ["o_orderkey"], "o_custkey", "s")
        want = df.withColumn("s", F.sum("o_custkey").over(Window.orderBy("o_orderkey")))
        assert rows(total) == rows(want)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_null_keys_come_last_and_numbering_goes_on(spark):
    first = assign_key(spark.createDataFrame([("b", None), ("b", 1), (None, 2)], "k string, v int"), ["k", "v"], "id")
    assert first.columns == ["id", "k", "v"]
    assert rows(first) == [(1, "b", 1), (2, "b", None), (3, None, 2)]
    more = assign_key(spark.createDataFrame([("a", 1)], "k string, v int"), ["k", "v"], "id", after=first)
    assert rows(more) == [(4, "a", 1)]


def test_empty(spark):
    empty = spark.createDataFrame([], "k string")
    assert rows(assign_key(empty, ["k"], "id")) == []
    assert rows(assign_key(spark.createDataFrame([("x",)], "k string"), ["k"], "id", after=assign_key(empty, ["k"], "id"))) == [(1, "x")]
    assert in_order("a", "b")
