"""Students, courses and products: table life cycle and the simple queries, on invented rows."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from saleswh.operators import maintain, quality, relational
from saleswh.operators.keys import assign_key
from saleswh.schemas import SCHEMAS
from saleswh.sources import create_view, drop_view, inline_rows


@pytest.fixture(scope="module")
def students(spark):
    people = [("Ines", 19, "Arts"), ("Omar", 27, "Computing"), ("Pia", 21, "Physics"), ("Quinn", 18, "Physics")]
    base = spark.createDataFrame(people, "name string, age int, major string")
    return assign_key(base, ["name"], "id")


@pytest.fixture(scope="module")
def enrollments(spark):
    return inline_rows(
        spark, [(1, 2, "Logic"), (2, 3, "Optics"), (3, 4, "Optics"), (4, 4, "Waves")], SCHEMAS["enrollments"]
    )


def test_keys_are_dense(students):
    assert rows(students.select("id", "name")) == [(1, "Ines"), (2, "Omar"), (3, "Pia"), (4, "Quinn")]


def test_add_and_update_column(students):
    df = maintain.add_column(students, "email", "string")
    for name in ("Ines", "Omar"):
        df = maintain.update_where(df, F.col("name") == name, {"email": f"{name.lower()}@example.org"})
    assert rows(df.select("name", "email")) == [
        ("Ines", "ines@example.org"), ("Omar", "omar@example.org"), ("Pia", None), ("Quinn", None)
    ]
    assert rows(quality.check_max_len(df, "email", 15).select("name")) == [("Ines",), ("Omar",)]
    assert rows(quality.check_not_null(df, ["name", "email"])) == [("email", 2)]


def test_delete_and_order(students):
    left = maintain.delete_where(students, F.col("name") == "Ines")
    assert [r.name for r in left.orderBy(F.col("AGE").desc()).collect()] == ["Omar", "Pia", "Quinn"]


def test_delete_keeps_unknown(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 9)], "i int, n int")
    assert rows(maintain.delete_where(df, F.col("n") > 6).select("i")) == [(1,), (2,)]


def test_rows_at_min_keeps_ties(students, spark):
    assert rows(relational.rows_at_min(students, "age").select("name")) == [("Quinn",)]
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 6), (4, None)], "i int, n int")
    assert rows(relational.rows_at_min(df, "n").select("i")) == [(1,), (2,)]


def test_counts(students):
    assert rows(relational.count_by(students, "major")) == [("Arts", 1), ("Computing", 1), ("Physics", 2)]
    assert rows(maintain.row_count(students)) == [(4,)]


def test_enrollment_queries(students, enrollments):
    joined = enrollments.join(students, F.col("student_id") == F.col("id")).select("name", "course")
    listed = [tuple(r) for r in joined.orderBy("name", "course").collect()]
    assert listed == [("Omar", "Logic"), ("Pia", "Optics"), ("Quinn", "Optics"), ("Quinn", "Waves")]
    busy = relational.groups_having(enrollments, "student_id", students, "id", "name", 1)
    assert rows(busy) == [("Quinn", 2)]
    assert rows(quality.check_fk(enrollments, "student_id", students, "id")) == []


def test_foreign_key_check(spark, students):
    child = spark.createDataFrame([(1, 2), (2, 9), (3, 9), (4, None)], "e int, student_id int")
    assert rows(quality.check_fk(child, "student_id", students, "id")) == [(9, 2)]


def test_insert_rows_goes_on_from_the_highest_key(spark, students):
    new = assign_key(
        spark.createDataFrame([("Remi", 22, "Computing")], "name string, age int, major string"),
        ["name"], "id", after=students,
    )
    grown = maintain.append(students, new)
    create_view(grown.filter(F.col("major") == "Computing"), "computing_students")
    assert rows(spark.sql("SELECT id, name FROM computing_students")) == [(2, "Omar"), (5, "Remi")]
    assert drop_view(spark, "computing_students")


def test_append_select_and_literals(spark, students, enrollments):
    dst = maintain.append_select(
        enrollments, students, F.col("name") == "Pia", {"student_id": F.col("id"), "course": "Logic"}
    )
    assert rows(dst.filter("enroll_id IS NULL").select("student_id", "course")) == [(3, "Logic")]
    more = maintain.append_rows(enrollments, [(9, 1, "Waves")])
    assert more.count() == 5 and more.schema == enrollments.schema


def test_defaults(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "i int, v string")
    got = maintain.apply_defaults(df, {"v": F.lit("new"), "is_current": F.lit(True), "at": F.current_timestamp()})
    assert rows(got.select("i", "v", "is_current")) == [(1, "new", True), (2, "x", True)]
    assert got.filter("at IS NULL").count() == 0


def test_unique(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "a"), (None, "a")], "i int, v string")
    assert rows(quality.check_unique(df, ["i", "v"])) == rows(
        spark.createDataFrame([(1, "a", 2), (None, "a", 2)], "i int, v string, n long")
    )


@pytest.mark.parametrize("n,block", [(1, 1000), (7, 1000), (7, 3), (6, 3), (8, 3)])
def test_replicate(spark, n, block):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "i int, v string")
    got = maintain.replicate(df, n, block)
    assert got.columns == df.columns
    assert rows(got.groupBy("i", "v").count()) == rows(df.groupBy("i", "v").agg((F.count("*") * n).alias("count")))


def test_replicate_needs_a_count(spark):
    with pytest.raises(ValueError):
        maintain.replicate(spark.range(1), 0)


def test_first_by_skips_nulls_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", 1, None), ("a", 2, "y"), ("a", 2, "x"), ("a", 3, "w"), ("b", 1, None)], "k string, t int, v string"
    )
    assert rows(relational.first_by(df, ["k"], ["v"], "t")) == [("a", "x"), ("b", None)]


def test_top_and_mode(spark):
    df = spark.createDataFrame(
        [("b", 5), ("a", 5), ("c", 4), (None, 99), ("c", 0)], "k string, v int"
    )
    assert [r.k for r in relational.top_k(df.filter("k IS NOT NULL"), "v", "k", 2).collect()] == ["a", "b"]
    assert rows(relational.top_group(df, "k", "v")) == [("a", 5)]
    assert rows(relational.mode_value(df, "k")) == [("c",)]
    assert rows(relational.mode_value(df.limit(0), "k")) == []
    assert [r.k for r in relational.choices(df, "k").collect()] == ["a", "b", "c", None]


def test_previous_period(spark):
    df = spark.createDataFrame([(2003, 10), (2005, 40), (2004, 20)], "y int, v int")
    assert rows(relational.previous_period(df, "y", "v")) == [(2005, 40, 20)]
    assert rows(relational.previous_period(df.filter("y = 2003"), "y", "v")) == [(2003, 10, None)]
    assert rows(relational.previous_period(df.limit(0), "y", "v")) == []
