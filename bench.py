"""Time the headline queries: one JSON line on stdout."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from martloom.plans.catalog import QUERIES  # noqa: E402
from martloom.session import local_session  # noqa: E402

HEADLINE = (
    "clean_text", "prepare_table", "stg_customers", "stg_geolocation", "stg_orders", "stg_products",
    "snapshot_timestamp", "snapshot_check", "dim_customer", "dim_product", "dim_geolocation", "dim_date",
    "fact_orders", "fact_sales", "fact_payments", "fact_fulfillment", "fact_reviews",
    "test_unique_combination", "test_relationships", "test_accepted_range", "run_tests",
    "rfm", "product_features", "customer_features", "standard_scale",
    "som_fit", "som_fit_full_map", "som_assign", "kmeans_sweep", "davies_bouldin", "silhouette_exact",
    "validate_model",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), app="bench")
    QUERIES["fact_sales"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
