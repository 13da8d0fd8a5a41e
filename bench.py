"""Benchmark the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query after one warm-up, default 3).
Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected to the driver); the best time is reported.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "ingest_orders",
    "order_rejects",
    "stg_orders",
    "fct_orders",
    "mart_payment_critical_time",
    "mart_users_blacklist",
    "mart_users_fraud_mostly",
    "mart_user_product_habit",
    "mart_product_payment",
    "daily_slice_orders",
    "upsert_products",
    "insert_users_if_absent",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))

    from fraudlens.plans.catalog import QUERIES, sources_from_tables
    from fraudlens.plans.models import run_models
    from fraudlens.session import get_session, scratch_dir
    from fraudlens.sources.tables import load_tables

    # two shuffle partitions per core; AQE coalesces small ones
    spark = get_session(f"local[{cpus}]", app_name="fraudlens-bench", shuffle_partitions=2 * cpus)

    def timed(fn) -> float:
        fn()  # warm-up
        best = float("inf")
        for _ in range(runs):
            t0 = time.perf_counter()
            fn()
            best = min(best, time.perf_counter() - t0)
        return best

    results: dict[str, float] = {}
    for name in HEADLINE:
        q = QUERIES[name]
        results[name] = round(timed(lambda: q(spark, sf_dir).write.format("noop").mode("overwrite").save()), 3)

    # full refresh: core tables written once, all five marts built from them
    def full_refresh() -> None:
        out = scratch_dir(spark, "bench-models")
        run_models(spark, sources_from_tables(load_tables(spark, sf_dir)), out, as_of="2025-11-06 00:00:00")

    results["run_models_full_refresh"] = round(timed(full_refresh), 3)

    # streaming: the whole topic through the continuous-ingest code path
    # (publish as JSON files, availableNow stream, read the sink back)
    results["stream_ingest_orders"] = round(
        timed(lambda: QUERIES["stream_ingest_orders"](spark, sf_dir).write.format("noop").mode("overwrite").save()), 3
    )

    # fraud-flag latency: a running stream (500 ms polling) receives one
    # day's events as a new topic file; time until they are committed
    from pyspark.sql import functions as F

    from fraudlens.sources import adapter
    from fraudlens.sources.topic import publish_orders
    from fraudlens.streaming.ingest import start_order_ingest

    base = scratch_dir(spark, "bench-latency")
    streams = start_order_ingest(spark, f"{base}/topic", f"{base}/orders", f"{base}/ckpt")
    events = adapter.raw_orders(load_tables(spark, sf_dir))
    days = ["1995-03-01", "1995-03-02", "1995-03-03", "1995-03-04"]
    lat = []
    for d in days:
        publish_orders(events.filter(F.col("created_date").startswith(d)), f"{base}/topic")
        t0 = time.perf_counter()
        streams.orders.processAllAvailable()
        lat.append(time.perf_counter() - t0)
    streams.stop()
    results["stream_day_latency"] = round(min(lat[1:]), 3)

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                "runs": runs,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
