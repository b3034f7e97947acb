"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is planned and run from the raw tables (nothing cached between runs) into a sink
that consumes every row and column. Two passes over all queries warm the JVM up; the figure
per query is the best of the next three passes.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from clientbook.plans import registry

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
WARM_UPS = int(os.environ.get("BENCH_WARM_UPS", "2"))
HEADLINE = (
    "revenue_by_period",
    "customer_360",
    "customer_segments",
    "customer_health",
    "concentration",
    "concentration_ladder",
    "rm_actions",
    "exceptions",
    "executive_summary",
    "customer_watchlist",
    "health_heatmap",
    "exception_feed",
    "customer_explorer_filtered",
    "segment_transitions",
)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("clientbook-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # Keep the generated classes of all queries, as a long-lived serving session would.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run_once(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    registry.queries()[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session()
    names = sys.argv[1:] or HEADLINE
    for _ in range(WARM_UPS):
        for name in names:
            run_once(spark, name)
    runs = [{name: run_once(spark, name) for name in names} for _ in range(RUNS)]
    seconds = {name: round(min(run[name] for run in runs), 3) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
