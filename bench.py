"""Time the headline queries: one warm-up run, then the median of the timed runs.

Prints one JSON line. ``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores,
``BENCH_RUNS`` the timed runs per query.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.compare import local_session  # noqa: E402
from checks.queries import QUERIES  # noqa: E402

HEADLINE = [
    "feature_table",
    "feature_table_fine_grain",
    "feature_table_incremental",
    "demand_panel",
    "daily_demand",
    "daily_markdowns",
    "daily_discounts",
    "enrich_dimensions",
    "enrich_markdowns",
    "enrich_discounts",
    "lag_features",
    "rolling_features",
    "forecast_frame",
    "inference_features",
    "history_split",
    "partition_manifest",
    "scan_csv",
    "scan_partitioned",
    "scan_date_window",
    "select_items_semi",
    "items_in_all_stores",
    "top_items",
    "assortment_profile",
    "dummies",
    "rmse",
    "category_index",
    "score_forecast",
    "train_forest",
    "write_features_roundtrip",
    "ingest_history",
    "ingest_day",
]


def seconds(spark, name: str, sf_dir: str) -> float:
    begun = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session(cpus)
    timed = {}
    for name in HEADLINE:
        seconds(spark, name, sf_dir)
        timed[name] = round(
            statistics.median(seconds(spark, name, sf_dir) for _ in range(runs)), 3
        )
        print(f"{name}: {timed[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of warm medians over the headline queries",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": float(Path(sf_dir).name.removeprefix("sf") or 0),
                "cpus": cpus,
                "runs": runs,
            }
        )
    )


if __name__ == "__main__":
    main()
