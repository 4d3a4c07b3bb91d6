"""Time the headline queries: one warm-up run, then the median of three.

Prints one JSON line. BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS set data, cores and runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tablewright.plans.catalog import QUERIES  # noqa: E402
from tablewright.session import build_session  # noqa: E402

HEADLINE = (
    "running_sales_report",
    "pricing_summary",
    "standard_aggregates",
    "monthly_order_totals",
    "salted_counts",
    "skew_report",
    "median_of_table",
    "event_pair_durations",
    "inner_join_on_two_names",
    "salted_join",
    "orders_without_lines",
    "not_in_subquery",
    "balance_vs_segment_mean",
    "running_total_by_row",
    "prefix_sum_of_table",
    "lag_lead_difference",
    "latest_order_row_number",
    "second_highest_or_highest",
    "rank_kinds",
    "islands_of_active_days",
    "capacity_cutoff",
    "snapshot_diff",
    "scd2_merge",
    "constraint_report",
    "word_count",
    "anagram_groups",
    "flatten_delimited",
    "windowed_event_counts",
)


def run(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
        master=f"local[{cpus}]",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        run(spark, folder, name)
        times[name] = round(statistics.median(run(spark, folder, name) for _ in range(runs)), 4)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
