"""Times the headline queries and prints one JSON line.

Each query is run twice over the tables in ``$BENCH_SF_DIR`` on
``local[$BENCH_CPUS]``; planning is included, the result goes to Spark's noop
sink, and the better time counts, so that class loading and compilation, which
a long-running job pays once, do not hide the work itself.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from saleswright.plans.registry import all_queries
from saleswright.session import build_session

HEADLINE = (
    "daily_category_metrics",
    "clean_sales",
    "clean_sales_rejects",
    "drop_nulls_distinct",
    "fact_sales",
    "customer_metrics",
    "customer_recency_window",
    "daily_sales_summary_all",
    "surrogate_keys_sales",
    "dq_run_all",
    "profile_duplicates",
    "defects_sales",
    "sink_parquet_roundtrip",
    "quick_report",
    "sink_partitioned_roundtrip",
    "warehouse_fact",
    "fact_append_idempotent",
    "dim_scd1_merge",
    "summary_upsert",
    "profile_sources",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "saleswright-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    spark.stop()
    scale = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_seconds_headline_queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "").isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
