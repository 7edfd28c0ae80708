"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from txclean.catalogue import queries

HEADLINE = [
    "cleaned_data",
    "merchant_fuzzy_match",
    "merchant_fuzzy_blocked",
    "merchant_corrected",
    "deduplicated",
    "duplicates_listed",
    "constraints_quarantine",
    "audit_log",
    "audit_lineage",
    "cleaning_summary",
    "cleaning_report",
    "documents_dedup",
    "lineitem_key_violations",
    "parse_mixed_dates",
    "sample_orders",
    "enrich_nation",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("txclean-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    catalogue = queries()
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = sys.argv[1:] or HEADLINE
    times = {}
    for name in wanted:
        seconds = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            catalogue[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - start)
        # The first run warms up code generation.
        times[name] = round(statistics.median(seconds[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
