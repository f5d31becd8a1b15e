"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Setup (timed apart, ``setup_sec``): the stand-in inputs derived from the
driver tables (CDC bronze rows, customer extract, card transactions) are
written once as Parquet, as the lake hands layers over; the queries then read
those tables. Each query result is fully materialised with the ``noop`` sink
(every column computed, nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "silver_orders",
    "customer_ltv",
    "fct_orders_merged",
    "dim_customers",
    "revenue_summary",
    "scd2_apply_step",
    "tier_at_order_time",
    "dq_suite_results",
    "tx_velocity",
    "offline_features",
    "fraud_decisions",
    "nightly_profile",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from ordermart.session import get_spark
    from ordermart.plans.queries import QUERIES

    spark = get_spark("ordermart-bench", local=True, cores=cpus,
                      extra_conf={"spark.sql.shuffle.partitions": os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(int(cpus))),
                                  "spark.driver.memory": "16g"})
    from ordermart.plans.queries import materialize_inputs
    from ordermart.session import scratch_path

    t0 = time.perf_counter()
    materialize_inputs(spark, sf_dir, scratch_path(spark, "bench-inputs"))
    setup = round(time.perf_counter() - t0, 3)
    times: dict[str, float] = {}
    for name in only or HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "setup_sec": setup,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
