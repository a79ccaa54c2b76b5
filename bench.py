"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from tallyloom.sources.session import build_session
from workload.catalog import QUERIES

HEADLINE = [
    "period_matrix",
    "months_12",
    "coarse_totals",
    "category_lookup",
    "scale_targets",
    "backorders",
    "ingest_month",
    "report_combined",
    "report_distributor",
    "report_targets",
    "report_titles",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        app="bench",
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        **{"spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
