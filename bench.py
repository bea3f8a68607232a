"""Time the registered queries and print one JSON line.

BENCH_SF_DIR picks the data folder, BENCH_CPUS the local cores, BENCH_QUERIES a comma-separated subset,
BENCH_RUNS the number of timed runs (the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from flowgauge.plans import load_all
from flowgauge.session import local_session


def once(query, spark, folder) -> float:
    start = time.perf_counter()
    # Every row and column is computed; nothing is collected or written.
    query.run(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(cpus, shuffle_partitions=max(8, int(cpus)) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    registry = load_all()
    once(registry["deployment_frequency_monthly"], spark, folder)  # warm-up: JVM, code generation, file cache
    seconds: dict[str, float] = {}
    for name, query in registry.items():
        if wanted and name not in wanted:
            continue
        seconds[name] = round(statistics.median(once(query, spark, folder) for _ in range(runs)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": folder.rsplit("sf", 1)[-1]}
        )
    )


if __name__ == "__main__":
    main()
