"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_RUNS`` the timed runs per
query after one warm-up (the median counts), ``BENCH_QUERIES`` an optional list of names.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.session import create_session  # noqa: E402
from ledgerline.suite import QUERIES  # noqa: E402

# query -> input table whose rows it reads
HEADLINE = {
    "g5_latest_per_key": "lineitem",
    "a1_order_totals": "lineitem",
    "g1_top_products": "lineitem",
    "g2_top_customers": "lineitem",
    "w4_status_distribution": "lineitem",
    "g7_hourly_trends": "events",
    "p10_fallback_not_needed": "events",
    "m2_rollup_all_slices": "events",
    "c4_hour_and_status_trend": "events",
    "c6_metric_changes": "orders",
    "c10_customer_segments": "orders",
    "a7_daily_revenue_with_gaps": "orders",
    "w1_w2_w3_moving_averages_with_gaps": "orders",
    "a8_t2_weekday_seasonality": "events",
    "t5_t10_revenue_forecast": "events",
    "t5_t10_revenue_forecast_per_product": "lineitem",
    "t11_forecast_summary": "events",
    "c7_actual_vs_forecast": "events",
    "p1_p5_decode_messages": "lineitem",
    "m1_x1_x4_k1_stream_upsert": "lineitem",
    "s3_order_snapshot_compacted": "lineitem",
    "s3_order_snapshot_many_commits": "lineitem",
    "m2_daily_job": "events",
    "m2_daily_job_falls_back": "events",
    "m4_forecast_job": "events",
    "w1_w2_w3_moving_averages_per_event": "events",
    "c10_customer_ntiles": "orders",
    "c6_distinct_customers_of_a_range": "orders",
    "x4_change_feed": "lineitem",
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split() or list(HEADLINE)
    spark = create_session(
        "bench",
        f"local[{cpus}]",
        int(cpus) if cpus.isdigit() else 8,
        {"spark.driver.memory": "12g", "spark.log.level": "ERROR"},
    )
    rows = {
        table: spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
        for table in set(HEADLINE.values())
    }
    seconds, rates = {}, {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
        rates[name] = round(rows[HEADLINE.get(name, "lineitem")] / seconds[name])
        print(f"{seconds[name]:8.3f}s {name}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "rows_per_sec": rates,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
