"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and BENCH_RUNS times for the median. Results go
to the noop sink, so every column of every row is computed and nothing is
collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from shelfwatch.plans.queries import QUERIES
from shelfwatch.runtime import build_session

HEADLINE = [
    "price_parse",
    "price_clean_currency",
    "clean_texts",
    "url_normalise",
    "link_extract",
    "product_extract",
    "listing_walk",
    "collect_catalogue",
    "dedup_two_key",
    "dedup_in_run",
    "validate_records",
    "validate_issues",
    "clean_records",
    "quality_counters",
    "dedup_first",
    "category_analysis",
    "catalog_kpis",
    "availability_breakdown",
    "rating_distribution",
    "price_distribution",
    "top_rated",
    "cheapest",
    "price_changes",
    "previous_prices_asof",
    "upsert_snapshot",
    "constraint_check",
    "run_log",
    "csv_roundtrip",
    "monitor_batches",
    "monitor_stream",
    "previous_prices_snapshot",
    "history_append",
    "dedup_chain",
    "link_resolve_hrefs",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    seconds = {}
    for name in names:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
