"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default all),
BENCH_REPEATS (default 3). Each query runs once untimed, then the mean of the repeats
counts. Reports are collected, as a user would; wide results go to the no-op sink.

BENCH_SCALES (default 1,10): the three reports also run on the flat table replicated to
these scales, written as Parquet, cached and counted before timing.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from saleswh.catalog import QUERIES  # noqa: E402
from saleswh.plans import reports  # noqa: E402
from saleswh.plans.tables import sales_flat  # noqa: E402
from saleswh.sources import prepare, prescale, read_scaled  # noqa: E402
from saleswh.storage import build_session, new_path, release  # noqa: E402

REPORTS = [
    "revenue_by_country", "top_product_lines", "monthly_sales",
    "revenue_by_country_flat", "top_product_lines_flat", "monthly_sales_flat",
    "kpis", "filtered_kpis", "yoy_growth", "top_customers", "customers_by_country",
    "product_performance", "sales_stats", "sales_patterns", "revenue_concentration",
    "sales_by_city", "price_gap_total", "distinct_cities_orders",
]
WIDE = [
    "sales_flat", "as_of_orders", "as_of_orders_array", "as_of_orders_sweep", "as_of_events", "event_history", "scd2_apply", "upsert",
    "dim_customer", "fact_sales", "replicate", "check_unique",
]


def run(spark, name: str, sf_dir: str) -> None:
    df = QUERIES[name](spark, sf_dir)
    if name in REPORTS:
        df.collect()
    else:
        df.write.format("noop").mode("overwrite").save()


def timed(action, repeats: int) -> float:
    action()
    start = time.perf_counter()
    for _ in range(repeats):
        action()
    return round((time.perf_counter() - start) / repeats, 4)


def scaled_reports(spark, sf_dir: str, scales: list[int], repeats: int) -> dict[str, float]:
    """The three reports on the flat table at each scale, spread over the cores and cached."""
    columns = ["country", "product_line", "year_id", "month_id", "month_name", "sales"]
    paths = prescale(sales_flat(spark, sf_dir, columns), new_path(spark, "bench"), scales)
    times = {}
    for scale, path in paths.items():
        flat = prepare(read_scaled(spark, path), max(8, 2 * spark.sparkContext.defaultParallelism))
        for report in (
            reports.revenue_by_country_flat, reports.top_product_lines_flat, reports.monthly_sales_flat
        ):
            times[f"cached_x{scale}_{report.__name__}"] = timed(lambda: report(flat).collect(), repeats)
        release(spark)
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = build_session(
        "saleswh-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": str(cpus), "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in REPORTS + WIDE:
        times[name] = timed(lambda: run(spark, name, sf_dir), repeats)
        release(spark)
    scales = [int(x) for x in os.environ.get("BENCH_SCALES", "1,10").split(",") if x]
    times.update(scaled_reports(spark, sf_dir, scales, repeats))
    print(
        json.dumps(
            {
                "metric": "total mean seconds over the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "cpus": cpus,
                "repeats": repeats,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
