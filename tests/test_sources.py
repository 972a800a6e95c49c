from datetime import datetime
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from saleswh import sources
from saleswh.functions import to_ts
from saleswh.schemas import SCHEMAS, create_table, drop_table, make_schema
from saleswh.storage import new_path, stage


def test_typed_csv(spark, tmp_path):
    (tmp_path / "p.csv").write_text("product_id,name,price\n1,Pen,1.00\n2,Ink,2.50\n3,Nib,0.80")
    df = sources.read_products(spark, str(tmp_path / "p.csv"))
    assert df.schema == SCHEMAS["products"]
    assert rows(df.filter(F.col("price") < 2.0).select("name")) == [("Nib",), ("Pen",)]
    figures = df.agg(F.max("price"), F.round(F.avg("price"), 4), F.sum("price")).collect()[0]
    assert tuple(figures) == (2.5, 1.4333, pytest.approx(4.3))
    inferred = sources.read_csv_inferred(spark, str(tmp_path / "p.csv"))
    assert dict(inferred.dtypes) == {"product_id": "int", "name": "string", "price": "double"}


def test_malformed_csv_is_an_error(spark, tmp_path):
    (tmp_path / "p.csv").write_text("product_id,name,price\n1,Pen,cheap\n")
    with pytest.raises(Exception, match="MALFORMED|cheap"):
        sources.read_products(spark, str(tmp_path / "p.csv")).collect()


def test_copy_text(spark, tmp_path):
    text = "3\tPia\t21\tPhysics\t\\N\n1\tIn\\tes\t19\tA\\\\rts\ti@example.org\n4\t\"Q\"\t18\t\t\\N\n\\.\n"
    (tmp_path / "s.txt").write_text(text)
    df = sources.read_copy_text(spark, str(tmp_path / "s.txt"), SCHEMAS["students"])
    assert df.schema == SCHEMAS["students"]
    assert rows(df) == [
        (1, "In\tes", 19, "A\\rts", "i@example.org"),
        (3, "Pia", 21, "Physics", None),
        (4, '"Q"', 18, "", None),
    ]


def test_missing_dataset_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        sources.read_scaled(spark, str(tmp_path / "none"))


def test_write_once(spark, tmp_path):
    path = str(tmp_path / "d")
    assert sources.write_once(spark.range(3), path).count() == 3
    assert sources.write_once(spark.range(9), path).count() == 3


def test_prescale(spark, tmp_path):
    base = str(tmp_path)
    paths = sources.prescale(spark.range(3), base, [1, 4])
    assert {n: sources.read_scaled(spark, p).count() for n, p in paths.items()} == {1: 3, 4: 12}
    sources.prescale(spark.range(9), base, [4])
    assert sources.read_scaled(spark, sources.scaled_path(base, 4)).count() == 12


def test_tables(spark):
    name = "dim_product_test"
    drop_table(spark, name)
    create_table(spark, name, new_path(spark, name), like="dim_product")
    assert spark.table(name).schema == SCHEMAS["dim_product"]
    part = spark.createDataFrame([("Cars", "S1", 9)], "product_line string, product_code string, product_key long")
    sources.append_table(part, name)
    sources.append_table(part, name, ["product_code"])
    assert rows(spark.table(name)) == [(9, "S1", "Cars", None), (None, "S1", None, None)]
    copied = sources.ctas("dim_product_copy", spark.table(name), new_path(spark, "copy"))
    assert rows(copied) == rows(spark.table(name))
    for t in (name, "dim_product_copy"):
        drop_table(spark, t)
        assert not spark.catalog.tableExists(t)


def test_append_creates_a_missing_table(spark):
    drop_table(spark, "fresh")
    sources.append_table(spark.range(2), "fresh", path=new_path(spark, "fresh"))
    assert spark.table("fresh").count() == 2
    drop_table(spark, "fresh")


def test_report_is_one_file(spark, tmp_path):
    path = tmp_path / "report"
    sources.write_report(spark.range(5).repartition(4), str(path))
    assert len(list(path.glob("*.csv"))) == 1
    assert sources.read_typed_csv(spark, str(path), make_schema(id="long")).count() == 5


def test_size(spark, tmp_path):
    path = tmp_path / "sized"
    spark.range(1000).write.parquet(str(path))
    want = sum(f.stat().st_size for f in path.glob("*.parquet"))
    got = sources.dataset_size_mb(spark, str(path)).collect()[0]
    assert got.size_mb == pytest.approx(want / 1048576)
    plan = sources.dataset_size_mb(spark, str(path))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<length:bigint>" in plan
    assert rows(sources.dataset_size_mb(spark, str(tmp_path / "none"))) == [(0, 0.0)]


def test_prepare_and_views(spark):
    df = sources.prepare(spark.range(10), 3)
    assert df.is_cached and df.rdd.getNumPartitions() == 3
    df.unpersist()
    sources.create_view(df, "ten")
    assert spark.sql("SELECT count(*) FROM ten").collect()[0][0] == 10
    assert sources.drop_view(spark, "ten") and not sources.drop_view(spark, "ten")


def test_versions_skip_unfinished_ones(spark, tmp_path):
    base = str(tmp_path / "v")
    first = sources.publish_version(spark.range(1), base)
    (tmp_path / "v" / "v00000009-dead").mkdir()
    assert sources.read_latest(spark, base).count() == 1
    second = sources.publish_version(spark.range(2), base)
    assert second > first and sources.read_latest(spark, base).count() == 2


def test_table_options():
    plain = sources.table_options("jdbc:x", "fact_sales", user="u")
    assert plain == {"url": "jdbc:x", "dbtable": "fact_sales", "user": "u"}
    query = sources.table_options("jdbc:x", "SELECT * FROM as_of_orders ;")
    assert query["dbtable"] == "(SELECT * FROM as_of_orders) AS src"
    split = sources.table_options("jdbc:x", "t", "id", 1, 100, 8)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "1", "100", "8")
    with pytest.raises(ValueError):
        sources.table_options("jdbc:x", "t", "id")


def test_timestamp_with_hour_offset(spark):
    df = spark.createDataFrame([("2025-10-07 11:05-06",)], "s string").select(to_ts("s").alias("t"))
    assert df.collect()[0].t == datetime(2025, 10, 7, 17, 5)


def test_stage_reads_back_the_same(spark):
    df = spark.createDataFrame([(1, Decimal("1.50"), None)], "i int, d decimal(12,2), s string")
    staged = stage(df)
    assert staged.schema == df.schema and rows(staged) == rows(df)


def test_report_keeps_the_order_of_the_frame(spark, tmp_path):
    frame = spark.range(0, 1000, 1, 8).selectExpr("id * 7919 % 1000 AS n").orderBy(F.col("n").desc())
    sources.write_report(frame, str(tmp_path / "r"))
    (file,) = (tmp_path / "r").glob("*.csv")
    assert file.read_text().split() == ["n", *map(str, range(999, -1, -1))]
