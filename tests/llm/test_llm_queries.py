"""Every named query of the subpackage against its check SQL."""

import os
import re
import sys

import pytest
from conftest import SF

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import check  # noqa: E402

from saleswh.llm import ORACLES, QUERIES  # noqa: E402

NATIVE = ("op4_pareto_mix", "op7_exact_dedup", "op10_line_runs")


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name in NATIVE:
        assert not re.search("Python|Pandas|Arrow", plan)
    if name in ORACLES:
        assert check.compare(df, con, ORACLES[name]) == ""
    else:
        assert len(df.collect()) > 0


def test_queries_without_sql():
    """The classifier, quotations, tokens and byte strings are compared with plain versions instead."""
    assert set(QUERIES) - set(ORACLES) == {"op1_crf_quality", "op2_quote_threads", "op6_byte_bpe", "op9_suffix_dedup"}
