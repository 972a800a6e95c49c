"""Every named query against its check SQL, and the shape of its plan."""

import os
import re
import sys

import pytest
from conftest import SF

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import check  # noqa: E402

import __spark_entry__ as entry_point  # noqa: E402
from saleswh.catalog import ORACLES, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"(Batch|Arrow)EvalPython|MapInPandas|FlatMapGroups", plan)
    if name in ORACLES:
        assert check.compare(df, con, ORACLES[name]) == ""
    else:
        assert len(df.collect()) > 0


def test_every_query_has_check_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) <= set(entry_point.queries()) and ORACLES.items() <= entry_point.oracle_sql().items()


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["country", "total_sales"]


@pytest.mark.parametrize(
    "name,columns",
    [
        # the semi-joins with the other dimensions need both keys
        ("top_product_lines_flat", "l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double"),
        ("top_countries", "l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double"),
        ("sales_stats", None),
    ],
)
def test_scans_read_only_what_they_need(spark, name, columns):
    plan = plan_of(QUERIES[name](spark, SF))
    if columns:
        assert f"ReadSchema: struct<{columns}>" in plan
    assert "l_tax" not in plan


def test_filters_reach_the_scan(spark):
    plan = plan_of(QUERIES["filtered_kpis"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01" in plan
    assert re.search(r"Filter .*o_orderdate#\d+ < 1999-07-01", plan)
    assert "EqualTo(p_type,ECONOMY)" in plan and "EqualTo(n_name,NATION_3)" in plan


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["top_customers"](spark, SF))


def test_star_reports_sum_before_the_join(spark):
    plan = plan_of(QUERIES["revenue_by_country"](spark, SF))
    assert plan.index("partial_sum(_sales") < plan.index("partial_sum(sales")


ORDERED = sorted(n for n, sql in ORACLES.items() if re.search(r"ORDER BY [\w, ]+(LIMIT \d+)?\s*$", sql))


@pytest.mark.parametrize("name", ORDERED)
def test_rows_come_in_order(spark, con, name):
    """The order itself, where the check SQL ends with one; rows that tie in all its columns may change places."""
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLES[name])
    by = set(re.findall(r"\w+", ORACLES[name].rsplit("ORDER BY", 1)[1]))
    places = [(i, c[0]) for i, c in enumerate(cur.description) if c[0] in by]
    want = [tuple(check._plain(r[i]) for i, _ in places) for r in cur.fetchall()]
    got = [tuple(check._plain(r[c]) for _, c in places) for r in df.collect()]
    assert places and got == want


def test_some_queries_are_ordered():
    assert {"sales_listing", "as_of_orders_short", "top_customers"} <= set(ORDERED)
