"""Times the headline queries on one machine and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma list, or
"all" for every registered query).
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from dupelens.queries import spark_queries

HEADLINE = (
    "duplicated_assets",
    "duplicate_group_report",
    "dq_summary",
    "catalog_a_summary",
    "catalog_b_summary",
    "backlog_catalog_a",
    "backlog_catalog_b",
    "anchored_clusters",
    "blocking_reduction",
    "blocked_pairs",
    "offset_vote_similarity",
    "fuzzy_duplicates",
    "detection_run_summary",
    "format_comparison",
    "robustness_ranking",
    "bit_diff_stats",
    "deep_compare",
    "similarity_histogram",
    "similarity_summary",
    "stratified_sample",
    "idempotent_upload",
    "upsert_retry",
    "stream_ingest",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    queries = spark_queries()
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(queries) if asked == "all" else [n for n in asked.split(",") if n] or list(HEADLINE)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("dupelens-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Starts the executors' code paths and the Python workers before the clock runs.
    queries["scan_fingerprints"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    queries["format_comparison"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
