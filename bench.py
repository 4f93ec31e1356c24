"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` picks the test folder, ``BENCH_CPUS`` the local threads. Each
query runs to the end into Spark's ``noop`` sink, once to warm up and once timed.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.plans.catalog import QUERIES
from tidemark.session import local_session

HEADLINE = (
    "feature_table_daily",
    "feature_table",
    "features_all",
    "features_split",
    "scaler_stats",
    "preprocess_job",
    "upsert_keep_last",
    "dedup_keys",
    "profile",
    "session_bar",
    "fetch_plan",
    "latest_price_volume",
    "forecast_15d",
    "forecast_wide",
    "eval_auc",
    "model_runs",
    "train_lr",
    "train_gbt",
    "daily_job",
    "market_summary",
    "top_buy",
    "recommendations",
    "week_breadth",
    "pred_summary",
    "stock_sorted_page",
)


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", os.cpu_count() or 8))
    seconds: dict[str, float] = {}
    for name in names or HEADLINE:
        for _ in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name:24} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
