"""Time the headline queries: prints one JSON line.

BENCH_SF_DIR names the data, BENCH_CPUS the number of local cores. Every
query runs once to warm up and BENCH_RUNS times measured; the fastest run
counts. All result columns and rows are computed, none are collected.
"""

from __future__ import annotations

import json
import os
import time

from testbed.queries import QUERIES
from watchlytics.session import build_session

HEADLINE = [
    "stg_users",
    "clean_delete_shared_load_ts",
    "fact_viewing_sessions",
    "dim_users",
    "dim_content",
    "dim_date",
    "content_performance_agg",
    "mart_content_performance",
    "mart_user_engagement",
    "mart_subscription_analytics",
    "popular_content",
    "daily_engagement",
    "top_content",
    "last_7_days",
    "plan_share",
    "verify_counts",
    "tv_show_sessions",
    "derive_completion",
    "dq_unique",
    "dq_relationships",
    "dq_unique_composite",
    "land_csv_dated",
    "load_csv_typed_viewing_sessions",
    "dq_report",
    "run_daily",
]


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        run(spark, name, sf_dir)
        seconds[name] = round(min(run(spark, name, sf_dir) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
