"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Warm session; per query one warm-up run, then the median of 3 timed runs.
A run executes the whole plan into the no-op sink (nothing is collected to
the driver). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from tidemark.plans.catalog import QUERIES  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "ohlcv_bars", "enrich", "enrich_users", "enrich_daily", "enrich_orders", "summary_totals", "anomaly_counts",
    "sort_symbol_date", "profile_combined", "profile_lineitem", "csv_scan_clean", "json_decode",
    "upsert_latest", "partial_update", "delete_by_key", "symbol_date_range", "point_lookup",
    "latency_summary", "batch_throughput", "stream_enrich", "stream_enrich_bucketed", "stream_upsert",
]


def run_once(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    spark = build_session(f"local[{cpus}]", int(cpus) * 2, app_name="tidemark-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    results = {}
    for name in names:
        run_once(spark, name, sf_dir)  # warm-up (also lands any cached inputs)
        times = [run_once(spark, name, sf_dir) for _ in range(reps)]
        results[name] = round(statistics.median(times), 3)
        print(f"{name:22s} {results[name]:8.3f}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_sec", "value": round(sum(results.values()), 3),
                      "unit": "sec", "queries": results, "sf": sf, "cpus": int(cpus),
                      "spark": spark.version, "reps": reps}))
    spark.stop()


if __name__ == "__main__":
    main()
