"""Headline queries, timed. Prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8),
``BENCH_RUNS`` (default 3; the median counts, after one warm-up run).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tableworks.plans import registry  # noqa: E402
from tableworks.session import build_session  # noqa: E402

HEADLINE = [
    "clean_entities", "apply_rules", "explode_list", "surrogate_key", "join_twice", "join_range", "join_theta_min", "join_asof",
    "map_codes", "entity_profile", "sensor_stats", "trailing_aggregates", "multi_level_totals", "top_n", "describe_table",
    "latest_per_key", "lead_lag", "rolling_range", "centered_mean", "back_adjust", "merge_intervals", "top_k_per_group",
    "apply_changes_scd1", "apply_changes_scd2", "merge_upsert", "change_feed", "expect", "expectation_metrics", "profile_metrics",
    "drift_metrics_numeric", "mask_columns", "training_set", "html_to_text", "chunk_fixed", "vector_top_k", "forecast_groups",
    "fraud_gold", "retail_gold",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session("bench", f"local[{cpus}]", spark_sql_shuffle_partitions=cpus, spark_ui_enabled="false",
                          spark_driver_memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    times: dict[str, float] = {}
    for name in HEADLINE:
        took = []
        for i in range(runs + 1):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            if i:
                took.append(time.perf_counter() - start)
        times[name] = round(statistics.median(took), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
