"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the number of cores. The first query warms the JVM
up. Then every query runs once more than ``BENCH_RUNS`` times; the median of all but the first
counts. A run builds the query, including the counting jobs some operators start, and computes all of
its rows and columns without collecting them.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession

from rowsmith.plans.queries import QUERIES

HEADLINE = (
    "multi_stage_etl",
    "rolling_mean_by_key",
    "rolling_mean_cumsum_by_key",
    "rolling_mean_by_large_key",
    "rolling_mean_cumsum_by_large_key",
    "rolling_mean_global",
    "rolling_mean_global_blocks",
    "rolling_sum_wide",
    "rolling_sum_wide_blocks",
    "cumsum_by_key",
    "cumsum_by_large_key",
    "rank_average",
    "rank_average_blocks",
    "feature_bundle",
    "feature_bundle_blocks",
    "scale_minmax_many",
    "scale_zscore_many",
    "broadcast_agg_map",
    "group_mean",
    "filter_group_sum",
    "metric_summary",
    "label_threshold",
    "label_then_join",
    "label_both_then_join",
    "join_inner",
    "join_full",
    "join_full_large_keys",
    "join_partitioned",
    "join_partitioned_large_keys",
    "array_filter_even",
    "map_batches_arrow",
    "map_groups_arrow",
    "sink_partitioned",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    for _ in range(3):
        run(wanted[0])
    seconds = {}
    for name in wanted:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            run(name)
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 4)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 4),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
