"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the timed runs of a query
(after one that is not timed; the median counts).  Streams run once.  Results go to Spark's ``noop``
sink, so every row and column is computed and none is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from footfall.plans.catalog import QUERIES  # noqa: E402
from footfall.runtime import build_session  # noqa: E402

BOUNDED = [
    "actions_clicks_pruned", "session_rollup", "sessions_filtered", "session_aggr_stat", "sessions_per_hour",
    "session_random_extract", "session_detail", "category_pivot", "top10_category", "top10_session",
    "page_pair_counts", "page_convert_rate", "city_product_clicks", "area_product_citycounts",
    "area_top3_product", "rank_per_group", "top1_per_group", "max_join_back", "window_agg_suite",
    "ad_user_click_count", "ad_blacklist", "ad_filtered_clicks", "ad_stat", "ad_province_top3",
    "ad_minute_clicks", "ad_click_trend", "ad_click_sliding",
]
STREAMS = ["stream_ad_stat", "stream_ad_province_top3", "stream_ad_minute_clicks"]


def seconds(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", str(min(8, os.cpu_count() or 8))))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.driver.host": "127.0.0.1",
    })
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in BOUNDED:
        seconds(spark, sf_dir, name)
        times[name] = round(statistics.median(seconds(spark, sf_dir, name) for _ in range(runs)), 3)
    for name in STREAMS:
        times[name] = round(seconds(spark, sf_dir, name), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus, "shuffle_partitions": cpus,
    }))


if __name__ == "__main__":
    main()
