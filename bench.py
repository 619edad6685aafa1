"""Wall time of the headline queries: one warm-up each, then the median of the timed runs.

Prints one JSON line. BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS override the defaults.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pricebench.catalog.queries import QUERIES
from pricebench.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "flagship",
    "parse_listings",
    "parse_yield",
    "strip_part_numbers",
    "weight_in_pounds",
    "deduplicate",
    "balanced_sample",
    "train_val_test_split",
    "describe_prices",
    "curate",
    "training_prompts",
    "vocabulary",
    "tfidf",
    "hand_features",
    "model_category_average",
    "apply_summaries",
    "price_replies",
    "to_price",
    "error_bands",
    "metrics",
    "worst_misses",
    "leaderboard",
    "scatter_points",
    "compare_models",
]
# Iterative fits: timed once, after everything above has warmed the session.
FITTED = [
    "model_features",
    "model_bow_ridge",
    "model_svd_ridge",
    "model_hashed_huber",
    "model_random_forest",
    "model_boosted_trees",
]


def seconds(spark, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        seconds(spark, name)
        times[name] = round(statistics.median(seconds(spark, name) for _ in range(RUNS)), 3)
    for name in FITTED:
        times[name] = round(seconds(spark, name), 3)
    total = round(sum(times.values()), 3)
    scale = SF_DIR.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_seconds", "value": total, "unit": "sec", "queries": times, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
