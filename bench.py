"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  folder with the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_ALL     set to 1 to time every registered query
"""

from __future__ import annotations

import json
import os
import time

from trailmart.plans.catalog import QUERIES
from trailmart.plans.models import MODELS
from trailmart.session import local_session

HEADLINE = (
    *MODELS,
    "top_category_brand",
    "journey_distribution",
    "experiment_user_metrics",
    "load_strict",
    "product_master",
    "missing_values",
    "daily_activity",
    "cardinality",
    "price_summary",
    "price_histogram_p99",
    "session_summary_medians",
)


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = list(QUERIES) if os.environ.get("BENCH_ALL") == "1" else HEADLINE
    spark = local_session("bench", cores, {"spark.sql.shuffle.partitions": cores})

    timings = {}
    for name in names:

        def run(query=QUERIES[name]) -> None:
            query(spark, sf_dir).write.format("noop").mode("overwrite").save()

        # The first run pays for class loading and code generation, the second is counted.
        run()
        timings[name] = round(seconds(run), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    result = {
        "metric": "total time of the headline queries, second run of each",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
