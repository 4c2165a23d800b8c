"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then three times; the median wall time of
computing all result rows (written to the ``noop`` sink) is reported.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tidemark.queries import QUERIES
from tidemark.session import build_session

HEADLINE = [
    "catch_up_windows",
    "silver_gapfill_5min",
    "silver_actionable_5min",
    "rollup_hour",
    "rollup_day",
    "tag_dimension",
    "ohlc",
    "portfolio_value",
    "revenue_by_source",
    "active_users",
    "abandoned_carts",
    "customer_options",
    "dedup_people",
    "purchase_revenue",
    "merge_upsert",
    "json_flatten",
    "agg_multi",
    "join_multiway",
    "top_k",
    "win_forward_fill",
    "win_running_max",
    "hourly_activity_stream",
    "bronze_parse",
    "agg_approx_distinct",
    "join_carry_previous",
    "box_stats",
    "stream_group_agg",
    "catch_up_from_target",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        shuffle_partitions=int(cpus),
        extra={"spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            begin = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - begin)
        times[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total median wall time of headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
