"""Rows and values that must not get lost on the way."""

import csv
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from saleswh.operators import documents, maintain, scd2
from saleswh.sources import append_table, read_typed_csv
from saleswh.storage import new_path


def test_partition_upsert_keeps_null_and_padded_partitions(spark):
    base = new_path(spark, "parts")
    kinds = "k string, m string, v int"
    documents.upsert_partitions(
        spark.createDataFrame([("a", None, 1), ("b", None, 2), ("c", "01", 3), ("d", "01", 4), ("e", "02", 5)], kinds), base, "k", "m"
    )
    documents.upsert_partitions(spark.createDataFrame([("z", None, 9), ("c", "01", 7)], kinds), base, "k", "m")
    got = spark.read.schema("k string, v int, m string").parquet(base).select("k", "m", "v").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(
        [("a", None, 1), ("b", None, 2), ("z", None, 9), ("c", "01", 7), ("d", "01", 4), ("e", "02", 5)], key=repr
    )


def test_change_without_time_is_late(spark):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    dim = scd2.scd2_init(spark.createDataFrame([("a", "x"), ("b", "y")], "k string, v string"), "k", start)
    changes = spark.createDataFrame([("a", "p", datetime(2024, 2, 1)), ("b", "q", None), ("n", "r", None)], "k string, v string, changed_at timestamp")
    accepted, late = scd2.split_late(dim, changes, "k")
    assert [r.k for r in accepted.collect()] == ["a"] and sorted(r.k for r in late.collect()) == ["b", "n"]


def test_unknown_columns_are_errors(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(1, 2)], "x int, z int")
    with pytest.raises(ValueError, match="z"):
        maintain.append(a, b)
    path = new_path(spark, "known")
    append_table(a, "known_columns", path=path)
    with pytest.raises(ValueError, match="z"):
        append_table(b, "known_columns")
    spark.sql("DROP TABLE known_columns")


def test_quotes_and_line_breaks_in_csv(spark, tmp_path):
    rows = [("1", 'The "Toy", Shop'), ("2", "two\nlines"), ("3", "plain")]
    with open(tmp_path / "a.csv", "w", newline="") as out:
        csv.writer(out).writerows([("id", "name"), *rows])
    from pyspark.sql.types import StructType

    got = read_typed_csv(spark, str(tmp_path / "a.csv"), StructType.fromDDL("id string, name string"), multi_line=True)
    assert sorted(map(tuple, got.collect())) == rows
