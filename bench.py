"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and
BENCH_RUNS (default 3, the median counts) set what runs. ``silver_build`` is the
one-off build of the stored bronze and silver tables that the gold queries read,
``gold_build`` that of the gold tables that the checks read.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINES = [
    "clean_strict", "bronze_summary", "bronze_revenue_by_country", "bronze_daily_volume",
    "dim_date", "dim_product", "fact_sales_daily", "fact_upsert", "gold_sales_monthly",
    "gold_product_performance", "gold_country_sales", "gold_daily_trend",
    "monthly_sales_summary", "top_products_by_revenue", "country_performance",
    "customer_lifetime_value", "customer_monthly_activity", "customer_product_affinity",
    "reconcile_layers", "dq_suite", "recompute_month", "log_level_counts", "ledger_repair",
    "stream_bronze",
]


def main() -> None:
    from tillworks.plans import registry, workspace
    from tillworks.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "tillworks-bench")
    queries = registry.queries()

    def drain(name: str) -> float:
        began = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    drain("bronze_revenue_by_country")  # JVM and file-system warm-up
    began = time.perf_counter()
    workspace.silver(spark, sf_dir)
    seconds = {"silver_build": time.perf_counter() - began}
    began = time.perf_counter()
    workspace.gold(spark, sf_dir, registry.AS_OF)
    seconds["gold_build"] = time.perf_counter() - began
    for name in HEADLINES:
        seconds[name] = statistics.median(drain(name) for _ in range(runs))
    spark.stop()
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": {n: round(s, 3) for n, s in seconds.items()},
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
