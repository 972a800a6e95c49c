from datetime import datetime, timedelta

import pytest
from conftest import at, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saleswh.operators import scd2
from saleswh.schemas import SCHEMAS
from saleswh.storage import stage


def test_init_opens_one_version_each(timeline):
    got = rows(timeline.first_customers.select("id", "customer_id", "valid_from", "valid_to", "is_current"))
    assert got == [(1, "C1", at(0), None, True), (2, "C2", at(0), None, True)]
    assert timeline.first_customers.schema.names == SCHEMAS["dim_customers"].names[:1] + [
        "customer_id", "name", "email", "city", "valid_from", "valid_to", "is_current"
    ]


def test_timeline_after_all_changes(timeline):
    got = rows(timeline.customers.select("id", "customer_id", "city", "valid_from", "valid_to", "is_current"))
    assert got == [
        (1, "C1", "New York", at(0), at(6), False),
        (2, "C2", "Boston", at(0), at(15), False),
        (3, "C1", "Chicago", at(6), None, True),
        (4, "C2", "Calgary", at(15), None, True),
    ]
    got = rows(timeline.products.select("id", "product_id", "price", "valid_from", "valid_to", "is_current"))
    assert [(i, p, str(c), f, t, o) for i, p, c, f, t, o in got] == [
        (1, "P1", "1000.00", at(0), at(10), False),
        (2, "P2", "500.00", at(0), None, True),
        (3, "P1", "900.00", at(10), None, True),
    ]


def test_single_steps_equal_the_batch(timeline):
    """Expire and insert one after the other, change by change, as a script would."""
    dim = timeline.first_customers
    for change in timeline.city_changes.orderBy("changed_at").collect():
        one = timeline.city_changes.filter(F.col("customer_id") == change.customer_id)
        dim = scd2.scd2_insert(scd2.scd2_expire(dim, one, "customer_id"), one, "customer_id")
    assert rows(dim) == rows(timeline.customers.select(*dim.columns))


def test_insert_copies_unchanged_attributes(timeline):
    new = timeline.customers.filter("id = 3").select("name", "email").collect()
    assert [tuple(r) for r in new] == [("Alice", "alice@icloud.com")]


def test_expire_closes_the_current_version_only(timeline):
    ends = timeline.city_changes.limit(1).select("customer_id", F.lit(at(30)).alias("changed_at"))
    got = rows(scd2.scd2_expire(timeline.customers, ends, "customer_id").select("id", "valid_to", "is_current"))
    assert got == [(1, at(6), False), (2, at(15), False), (3, at(30), False), (4, None, True)]


def test_insert_for_an_unknown_key_adds_nothing(timeline, spark):
    change = spark.createDataFrame([("C9", "Oslo", at(20))], timeline.city_changes.schema)
    assert scd2.scd2_insert(timeline.customers, change, "customer_id").count() == 4


def test_current_and_history(timeline):
    assert rows(scd2.scd2_current(timeline.customers).select("id")) == [(3,), (4,)]
    counts = scd2.version_attribute_count(timeline.customers, "customer_id", "city")
    assert [tuple(r) for r in counts.collect()] == [("C1", 2), ("C2", 2)]


def test_latest_per_key(timeline):
    got = scd2.latest_per_key(timeline.customers, "customer_id", "id")
    assert rows(got.select("customer_id", "city")) == [("C1", "Chicago"), ("C2", "Calgary")]


@pytest.fixture(scope="module")
def mixed(spark):
    return spark.createDataFrame(
        [
            ("C1", "Chicago", None, at(20)),  # equal to the current city
            ("C2", "Denver", None, at(20)),  # two changes of one key
            ("C2", None, "b2@icloud.com", at(25)),  # only the mail changes
            ("C3", "Oslo", "c@icloud.com", at(30)),  # no version yet
            ("C1", "Paris", None, at(3)),  # before the current version
        ],
        "customer_id string, city string, email string, changed_at timestamp",
    )


def test_batch_with_every_kind_of_change(timeline, mixed):
    dim = scd2.scd2_apply(timeline.customers, mixed, "customer_id")
    got = rows(dim.filter("id > 2").select("id", "customer_id", "city", "email", "valid_from", "valid_to"))
    assert got == [
        (3, "C1", "Chicago", "alice@icloud.com", at(6), None),
        (4, "C2", "Calgary", "bob@icloud.com", at(15), at(20)),
        (5, "C2", "Denver", "bob@icloud.com", at(20), at(25)),
        (6, "C2", "Denver", "b2@icloud.com", at(25), None),
        (7, "C3", "Oslo", "c@icloud.com", at(30), None),
    ]
    late = scd2.split_late(timeline.customers, mixed, "customer_id")[1]
    assert rows(late.select("customer_id", "city")) == [("C1", "Paris")]


def test_applying_twice_changes_nothing(timeline, mixed):
    once = stage(scd2.scd2_apply(timeline.customers, mixed, "customer_id"))
    assert rows(scd2.scd2_apply(once, mixed, "customer_id")) == rows(once)


def test_hot_keys_are_sliced_to_the_same_result(timeline, mixed):
    plain = scd2.scd2_apply(timeline.customers, mixed, "customer_id")
    plain = rows(plain)
    for unit in ("minute", "hour"):
        hot = scd2.scd2_apply(timeline.customers, mixed, "customer_id", hot_rows=0, slice_units=(unit, "second"))
        assert rows(hot) == plain


def test_changes_at_one_instant_count_as_one(timeline, spark):
    changes = spark.createDataFrame(
        [("C1", "Rome", 1, at(40)), ("C1", "Bern", 2, at(40)), ("C2", "Rome", 1, at(40)), ("C2", "Calgary", 2, at(40))],
        "customer_id string, city string, no int, changed_at timestamp",
    )
    dim = scd2.scd2_apply(timeline.customers, changes, "customer_id", tiebreak="no")
    # C2 ends the instant where it started, so it gets no version
    assert rows(dim.filter("is_current").select("customer_id", "city", "valid_from")) == [
        ("C1", "Bern", at(40)),
        ("C2", "Calgary", at(15)),
    ]


START = datetime(2024, 1, 1)
LOG = st.lists(
    st.tuples(st.integers(0, 3), st.integers(1, 300), st.sampled_from(["a", "b", "c"])), min_size=1, max_size=60
)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(LOG)
def test_versions_tile_time(spark, log):
    """Versions of a key neither gap nor overlap, one is current, neighbours differ, ids are dense."""
    dim = scd2.scd2_init(
        spark.createDataFrame([(0, "a"), (1, "b")], "k int, v string"), "k", F.lit(START)
    )
    changes = spark.createDataFrame(
        [(k, v, START + timedelta(minutes=m)) for k, m, v in log], "k int, v string, changed_at timestamp"
    )
    for hot_rows in (10**6, 3):
        got = sorted(
            (r.k, r.valid_from, r.valid_to, r.v, r.is_current, r.id)
            for r in scd2.scd2_apply(dim, changes, "k", hot_rows=hot_rows).collect()
        )
        assert sorted(r[5] for r in got) == list(range(1, len(got) + 1))
        for k in {r[0] for r in got}:
            mine = [r for r in got if r[0] == k]
            assert [r[4] for r in mine] == [False] * (len(mine) - 1) + [True]
            for left, right in zip(mine, mine[1:]):
                assert left[2] == right[1] and left[3] != right[3]
            assert mine[-1][2] is None
            # the newest version holds the last reported value
            last = max((m, v) for kk, m, v in log if kk == k) if any(kk == k for kk, _, _ in log) else None
            if last:
                assert mine[-1][3] == last[1]


def test_history_from_log(spark):
    log = spark.createDataFrame(
        [(1, 1, "a"), (1, 2, "a"), (1, 3, "b"), (1, 4, None), (1, 5, None), (1, 6, "b"), (2, 1, "a")],
        "k int, m int, v string",
    ).withColumn("ts", F.lit(START) + F.make_dt_interval(mins=F.col("m")))
    want = [(1, "a", 1, 3), (1, "b", 3, 4), (1, None, 4, 6), (1, "b", 6, None), (2, "a", 1, None)]
    for options in ({}, {"hot_rows": 0, "slice_units": ("minute", "second")}, {"hot_rows": 3}):
        got = scd2.history_from_log(log, "k", "ts", ["v"], **options)
        minutes = rows(got.select("k", "v", F.minute("valid_from"), F.minute("valid_to")))
        assert minutes == sorted(want, key=repr)


def test_a_batch_is_shuffled_once(spark, monkeypatch):
    """Open versions and changes meet in one exchange by key; all windows use it."""
    seen = []
    plain = scd2.stage
    monkeypatch.setattr(scd2, "stage", lambda df, label: seen.append(df._jdf.queryExecution().executedPlan().toString()) or plain(df, label))
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    dim = scd2.scd2_init(spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], "k string, v string, w int"), "k", start)
    changes = spark.createDataFrame(
        [("a", "p", datetime(2024, 2, 1), 1), ("a", "q", datetime(2024, 2, 1), 2), ("c", "r", datetime(2024, 3, 1), 1)],
        "k string, v string, changed_at timestamp, no int",
    )
    got = scd2.scd2_apply(dim, changes, "k", tiebreak="no")
    assert sorted((r.k, r.v, r.w, r.is_current) for r in got.collect() if r.k != "c") == [("a", "q", 1, True), ("a", "x", 1, False), ("b", "y", 2, True)]
    assert len(seen) == 1 and seen[0].count("Exchange") == 1
