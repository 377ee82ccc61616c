"""Time the headline queries: one warm-up run, then the median of three. Prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

HEADLINE = [
    "business_performance", "city_analytics", "top_categories", "user_engagement", "star_features", "star_features_salted",
    "dedup_two_keys", "dedup_latest", "checkin_explode", "pii_mask_text", "text_enrich", "pii_inspect", "deid_mask",
    "dq_suite", "dq_fact_unique", "bronze_key_stats", "merge_scd1", "merge_scd1_multi", "merge_insert_only",
    "scd2_business", "scd2_user", "dlq_split", "infer_types", "weather_enrich", "standardize", "regression_metrics",
]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from smelter.registry import catalog
    from smelter.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        taken = []
        for _ in range(1 + RUNS):
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cpus), "runs": RUNS}))


if __name__ == "__main__":
    main()
