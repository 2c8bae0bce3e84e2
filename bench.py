"""Time the headline queries and print one JSON line.

Each query is planned and run to the end once, rows going nowhere. BENCH_SF_DIR names the tables,
BENCH_CPUS the cores, BENCH_QUERIES (comma-separated) other queries than the headline ones.
"""

from __future__ import annotations

import json
import os
import re
import time

from basketry.plans.registry import queries
from basketry.session import local_session

HEADLINE = (
    "sku_catalog", "sku_dimension", "base_transactions", "customer_type_counts", "region_of_customer",
    "regional_ratings", "regional_als", "ranked_candidates", "recommend_types", "type_pair_reference",
    "sku_pairs", "sku_pairs_by_transaction", "sku_recommendations", "reactivated_purchases", "purchase_gaps",
    "reactivation_base", "point_in_time_features", "life_stage_flags", "reactivation_features",
    "scoring_customers", "latest_features", "scoring_features", "impute_features", "train_propensity",
    "calibrate_scores", "pivot_scores", "top_types_per_customer", "score_checkpoint", "nearest_centroid",
    "cluster_customers", "stream_events", "session_pairs",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = local_session(cores, partitions=8, name="bench")
    spark.range(1000).groupBy("id").count().write.format("noop").mode("overwrite").save()
    runs = queries()
    seconds = {}
    for name in chosen:
        start = time.perf_counter()
        runs[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
