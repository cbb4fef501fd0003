"""Headline queries, warm: one untimed run, then the median of the timed ones.

Prints one JSON line.  BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS set folder, cores and runs."""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "unified_demand_signals", "inventory_metrics_gold", "prime_monthly", "subaward_monthly", "subaward_pivot",
    "trade_risk_index", "commodity_enriched", "weather_index", "top_vendors", "top_suppliers", "supplier_concentration",
    "search_contracts", "rolling_demand_stats", "inventory_risk", "dedupe_first", "upsert_indicators", "normalize_awards",
    "detect_anomalies", "demand_features", "health_scores", "executive_briefing", "classify_events", "extract_country",
    "eval_composite", "forecast_fourier", "forecast_ar", "forecast_rf", "rf_intervals", "forecast_arima", "forecast_changepoints",
]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from procurelytics.plans.catalog import QUERIES
    from procurelytics.session import local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[1:]), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    sf = os.path.basename(folder.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_warm_query_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
