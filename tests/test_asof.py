import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from conftest import at, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from saleswh.operators.asof import History, as_of_join, as_of_lookup, as_of_orders, as_of_orders_short
from saleswh.schemas import SCHEMAS

GOLDEN = [
    ("O1", at(5), "C1", "Alice", "New York", "P1", "Laptop", Decimal("1000.00"), Decimal("1000.00")),
    ("O2", at(15), "C1", "Alice", "Chicago", "P1", "Laptop", Decimal("900.00"), Decimal("850.00")),
    # ordered at the very instant of the move: the new city
    ("O3", at(15), "C2", "Bob", "Calgary", "P2", "Phone", Decimal("500.00"), Decimal("500.00")),
    ("O4", at(15), "C1", "Alice", "Chicago", "P1", "Laptop", Decimal("900.00"), Decimal("900.00")),
]


@pytest.mark.parametrize("options", [{}, {"method": "sweep"}, {"method": "sweep", "hot_rows": 0}, {"method": "array"}])
def test_golden_view(timeline, options):
    view = as_of_orders(timeline.orders, timeline.customers, timeline.products, **options)
    assert view.columns == SCHEMAS["orders_summary"].names
    assert rows(view) == GOLDEN


def test_short_form(timeline):
    view = as_of_orders(timeline.orders, timeline.customers, timeline.products)
    short = as_of_orders_short(view)
    assert "customer_name" not in short.columns and "product_name" not in short.columns
    assert [r.order_id for r in short.collect()] == ["O1", "O2", "O3", "O4"]


@pytest.mark.parametrize("options", [{}, {"method": "sweep"}, {"method": "sweep", "hot_rows": 0}, {"method": "array"}])
def test_unmatched_orders(spark, timeline, options):
    """Before the first version, or without any: gone from the inner join, nulls in the left join."""
    odd = spark.createDataFrame(
        [("O8", "C1", "P1", at(0) - timedelta(minutes=1), Decimal("1.00")), ("O9", "C7", "P1", at(20), Decimal("1.00")),
         ("O7", None, "P1", at(20), Decimal("1.00"))],
        SCHEMAS["fact_orders"],
    )
    both = timeline.orders.unionByName(odd)
    city = {"city": "city"}
    inner = as_of_join(both, timeline.customers, "customer_id", "order_date", city, **options)
    assert rows(inner.select("order_id")) == [("O1",), ("O2",), ("O3",), ("O4",)]
    left = as_of_join(both, timeline.customers, "customer_id", "order_date", city, how="left", **options)
    assert rows(left.filter("city IS NULL").select("order_id")) == [("O7",), ("O8",), ("O9",)]
    assert left.count() == 7


def test_gap_between_versions(spark):
    dim = spark.createDataFrame(
        [(1, "a", at(0), at(5)), (1, "none", at(5), at(5)), (1, "b", at(10), None)],
        "k int, v string, valid_from timestamp, valid_to timestamp",
    )
    fact = spark.createDataFrame([(1, at(m)) for m in (0, 4, 5, 7, 10, 11)], "k int, t timestamp")
    want = [(1, at(0), "a"), (1, at(4), "a"), (1, at(10), "b"), (1, at(11), "b")]
    for options in ({}, {"method": "sweep"}, {"method": "sweep", "hot_rows": 0, "slice_units": ("minute", "second")}, {"method": "array"}):
        assert rows(as_of_join(fact, dim, "k", "t", {"v": "v"}, **options)) == sorted(want, key=repr)


def test_wrong_options(timeline):
    with pytest.raises(ValueError):
        as_of_join(timeline.orders, timeline.customers, "customer_id", "order_date", {}, how="outer")
    with pytest.raises(ValueError):
        as_of_join(timeline.orders, timeline.customers, "customer_id", "order_date", {}, method="guess")


START = datetime(2024, 1, 1)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.dictionaries(st.integers(0, 2), st.lists(st.integers(0, 200), min_size=1, max_size=8, unique=True), min_size=1),
    st.lists(st.tuples(st.integers(0, 3), st.integers(0, 220)), min_size=1, max_size=40),
)
def test_both_forms_agree_with_brute_force(spark, starts, facts):
    when = lambda m: START + timedelta(minutes=m)
    versions = []
    for k, minutes in starts.items():
        ms = sorted(minutes)
        versions += [(k, f"{k}-{m}", when(m), when(n) if n is not None else None) for m, n in zip(ms, ms[1:] + [None])]
    dim = spark.createDataFrame(versions, "k int, v string, valid_from timestamp, valid_to timestamp")
    fact = spark.createDataFrame([(i, k, when(m)) for i, (k, m) in enumerate(facts)], "i int, k int, t timestamp")
    want = sorted(
        (i, v) for i, (k, m) in enumerate(facts) for kk, v, f, t in versions
        if kk == k and f <= when(m) and (t is None or when(m) < t)
    )
    assert len({i for i, _ in want}) == len(want)
    for options in ({}, {"method": "sweep"}, {"method": "sweep", "hot_rows": 4}):
        got = as_of_join(fact, dim, "k", "t", {"v": "v"}, **options).select("i", "v")
        assert sorted(tuple(r) for r in got.collect()) == want


MINUTES = "k int, v string, valid_from timestamp, valid_to timestamp"


def _random_case(spark, seed, keys, versions, facts):
    """Versions that do not overlap, some empty, and facts around them; key 1 holds a third of both."""
    rng = random.Random(seed)
    dim, fact = [], []
    for k in range(keys):
        cuts = sorted(rng.sample(range(0, 50_000), versions * (10 if k == 1 else 1)))
        for a, b in zip(cuts, [*cuts[1:], None]):
            end = None if b is None else min(b, a + rng.choice([0, 5, 100_000]))
            dim.append((k, f"{k}/{a}", at(0) + timedelta(seconds=a), None if end is None else at(0) + timedelta(seconds=end)))
    for i in range(facts):
        k = 1 if i % 3 == 0 else rng.randrange(keys + 1)
        fact.append((i, k if i % 50 else None, None if i % 70 == 0 else at(0) + timedelta(seconds=rng.randrange(-9, 50_009))))
    dim.append((None, "no key", at(0), None))
    dim.append((2, "no start", None, None))
    return spark.createDataFrame(dim, MINUTES), spark.createDataFrame(fact, "i int, k int, t timestamp")


@pytest.mark.parametrize("most", [1, 4, 30, 4096])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_arrays_like_the_join(spark, most, how):
    dim, fact = _random_case(spark, most, 6, 8, 400)
    want = rows(as_of_join(fact, dim, "k", "t", {"v": "v", "since": "valid_from"}, how=how))
    got = as_of_lookup(fact, [History(dim, "k", {"v": "v", "since": "valid_from"})], "t", how, most)
    assert rows(got) == want


@pytest.mark.parametrize("how", ["inner", "left"])
def test_two_dimensions_at_once(spark, how):
    """Keys of different types, null keys, and facts that repeat a combination."""
    one, fact = _random_case(spark, 7, 5, 6, 300)
    two, _ = _random_case(spark, 8, 5, 6, 0)
    two = two.select(F.concat(F.lit("K"), "k").alias("code"), "v", "valid_from", "valid_to")
    fact = fact.withColumn("code", F.when(F.col("i") % 11 > 0, F.concat(F.lit("K"), (F.col("i") % 6).cast("string")))).drop("i")
    fact = fact.unionAll(fact)
    chain = as_of_join(as_of_join(fact, one, "k", "t", {"a": "v"}, how=how), two, "code", "t", {"b": "v"}, how=how)
    got = as_of_lookup(fact, [History(one, "k", {"a": "v"}), History(two, "code", {"b": "v"})], "t", how, most=16)
    assert rows(got) == rows(chain)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_versions_are_never_broadcast(timeline, how):
    """Versions made from small files can be many, and a broadcast passes all of them through the driver."""
    view = as_of_orders(timeline.orders, timeline.customers, timeline.products, how=how)
    assert rows(view) == GOLDEN
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") >= 2


def test_facts_are_shuffled_once(spark, timeline):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        view = as_of_orders(timeline.orders, timeline.customers, timeline.products, method="array")
        plan = view._jdf.queryExecution().executedPlan()
        assert rows(view) == GOLDEN
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moved = [line for line in _exchanged(plan) if "amount" in line]
    assert len(moved) == 1


def _exchanged(plan):
    """The output columns of every shuffle of a plan."""
    found, todo = [], [plan.initialPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            found.append(node.output().toString())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found
