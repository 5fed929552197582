"""Benchmark: prints one JSON line with seconds per query.

BENCH_SF_DIR   data folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from feedloom.plans.queries import QUERIES  # noqa: E402
from feedloom.session import local_session  # noqa: E402

# Input table of each throughput figure (rows of it per second).
THROUGHPUT = {
    "thread_parse": "conversations",
    "media_best_variant": "events",
    "feed_dedup_cap": "events",
    "upsert_merge": "documents",
    "normalize_pages": "pages",
    "normalize_noise": "documents",
    "redact_documents": "documents",
    "text_index_terms": "documents",
    "safe_int": "lineitem",
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(QUERIES)
    spark = local_session(cpus)
    # A first run pays for starting workers and compiling; it is reported apart.
    start = time.perf_counter()
    QUERIES["thread_parse"](spark, folder).write.format("noop").mode("overwrite").save()
    warm_up = round(time.perf_counter() - start, 3)
    seconds, rates = {}, {}
    for name in names:
        start = time.perf_counter()
        # The noop sink runs the whole query without moving rows to the driver.
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        if name in THROUGHPUT:
            rows = spark.read.parquet(f"{folder}/{THROUGHPUT[name]}.parquet").count()
            rates[name] = round(rows / seconds[name])
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "warm_up": warm_up,
                "rows_per_second": rates,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
