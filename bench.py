"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "feature_table",
    "feature_table_orders",
    "rolling_events",
    "rolling_orders",
    "rolling_events_split",
    "spend_view",
    "features_as_of",
    "pit_purchases_views",
    "historical_features",
    "fraud_training_set",
    "credit_training_set",
    "training_pull",
    "materialize_transactions",
    "materialize_credit",
    "lookup_fraud_features",
    "transactions_suite",
    "training_suite",
    "validation_null_rates",
    "validation_drift",
    "ks_lineitem",
    "wasserstein_lineitem",
    "jensen_shannon_lineitem",
    "psi_lineitem",
    "chi_squared_events",
    "feature_drift_events",
    "prediction_drift",
    "model_health",
    "alert_routing",
    "stratified_split",
    "ranking_scores",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE

    from pyspark.sql import SparkSession

    from tidemark.plans import catalog

    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in wanted:
        best = None
        for _ in range(2):  # the first run also compiles; the better one counts
            start = time.perf_counter()
            catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(f"{name}: {best:.2f}s", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
