"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_QUERIES comma-separated names (default: the list below)

Each query runs once to warm up and once for the record; all result rows are produced, none is kept.
"""

from __future__ import annotations

import json
import os
import time
import warnings

from checks import REGISTRY
from tidemark.session import get_spark

HEADLINE = [
    "list_strings",
    "engineered_features",
    "training_features",
    "rolling_events",
    "rolling_all_prior",
    "rolling_warm_start",
    "split_by_date",
    "five_folds",
    "without_rare_classes",
    "platform_rate_lookup",
    "merge_drifted_files",
    "feature_group_round_trip",
    "joined_feature_view",
    "ordinal_codes",
    "target_encoding_cross_fit",
    "tfidf_weights",
    "class_scores",
    "metric_trajectory",
    "shipping_lag",
    "stream_rolling",
]


def main() -> None:
    warnings.simplefilter("ignore")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = get_spark(
        f"local[{cpus}]",
        "bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
