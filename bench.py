"""Benchmark of headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=4 python bench.py

Each query runs to completion into Spark's ``noop`` sink (every row is
computed, nothing is collected) and is timed; prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketry.plans import catalog  # noqa: E402
from basketry.session import get_session  # noqa: E402

HEADLINE = [
    "rfm_churn", "customer_metrics", "customer_feature_stats", "customer_lifetime_value",
    "product_feature_stats", "product_promo_metrics", "channel_sales", "channel_monthly_sales",
    "category_variety", "days_between_purchases", "monthly_trend_feature", "daily_rolling_features",
    "holiday_features", "calendar_features", "sales_histogram", "category_quantity_box",
    "correlation_matrix", "brand_frequency_encoding", "forecast_metrics", "churn_rule_auc",
    "weekly_additive_decomposition", "daily_multiplicative_decomposition", "region_stationarity",
    "knn_imputed_lags", "streaming_hourly_event_sales", "forecast_models", "customer_segments",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    names = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", app="basketry-bench", shuffle_partitions=2 * cpus,
                        extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "6g")})
    # warm-up: JVM code paths and the parquet footers of the fact tables
    catalog.QUERIES["channel_sales"].build(spark, sf_dir).write.format("noop").mode(
        "overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        df = catalog.QUERIES[name].build(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_headline_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
