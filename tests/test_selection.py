"""Values at ranks, compared with sorting."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from saleswh.operators import selection
from saleswh.operators.selection import bracket, select_ranks
from saleswh.plans import bi


def want(values, ranks):
    values = sorted(v for v in values if v is not None)
    return [(values[r], sum(v < values[r] for v in values)) for r in ranks]


CASES = {
    "spread": [random.Random(1).randrange(10**12) for _ in range(3000)],
    "hot": [7] * 1000 + [random.Random(2).randrange(20) for _ in range(1500)],
    "tail": [random.Random(3).randrange(50) for _ in range(900)] + [10**15 + i for i in range(9)],
    "negative": list(range(-500, 500)) + [None] * 40,
    "one": [5],
    "longs": [-(2**63), 2**63 - 1, 0, 1, 2**62],
}


@pytest.mark.parametrize("case", sorted(CASES))
def test_like_sorting(spark, case):
    values = CASES[case]
    df = spark.createDataFrame([(v,) for v in values], "`a b` bigint").coalesce(2)
    known = sorted(v for v in values if v is not None)
    middle = len(known) // 2
    ranks = [max(middle - 1, 0), middle]
    assert select_ranks(df, ranks, known[0], known[-1]) == want(values, ranks)
    # few values and slices, and a guess that encloses too little
    assert select_ranks(df, ranks, known[middle], known[middle], 256, 8) == want(values, ranks)


def test_doubles_and_decimals(spark):
    rng = random.Random(4)
    doubles = [rng.choice([1, 1e-300, 1e300]) * rng.gauss(0, 1) for _ in range(500)] + [0.1, 0.1 + 1e-17, float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in doubles], "v double").coalesce(2)
    assert select_ranks(df, [250, 251], float("-inf"), float("inf"), 512, 4) == want(doubles, [250, 251])
    cents = [Decimal(rng.randrange(1000)).scaleb(-2) for _ in range(400)]
    df = spark.createDataFrame([(v,) for v in cents], "v decimal(12,2)")
    assert select_ranks(df, [199, 200], min(cents), max(cents), 64, 4) == want(cents, [199, 200])


def test_rank_beyond_the_rows(spark):
    with pytest.raises(ValueError, match="beyond"):
        select_ranks(spark.range(3), [3], 0, 2)


def test_bracket_encloses_the_median(spark):
    df = spark.range(100_000).select((F.col("id") * 7919 % 100_003).alias("v"))
    low, high = df.agg(*bracket("v", 0.5)).collect()[0]
    ((value, below),) = select_ranks(df, [50_000], low, high)
    assert low <= value <= high and below == 50_000 and high - low < 1000


def test_no_sort_and_no_written_column(spark, monkeypatch):
    """What the median shuffles does not grow with the rows: a row per task and range."""
    seen = []
    plain = selection._values
    monkeypatch.setattr(selection, "_values", lambda rows, *a: seen.append(rows) or plain(rows, *a))
    flat = spark.range(0, 200_000, 1, 4).select((F.col("id") % 5000).cast("decimal(12,2)").alias("sales"))
    assert bi.sales_stats(flat).collect()[0].median == 2499.5
    assert len(seen) == 1
    assert "Sort " not in seen[0]._jdf.queryExecution().executedPlan().toString()
