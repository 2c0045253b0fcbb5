"""Times the registered queries and prints one JSON line.

Each query is built and run in full once. ``BENCH_QUERIES`` names a comma-separated choice.
"""

from __future__ import annotations

import json
import os
import sys
import time

from fraudlane.catalog.queries import all_queries
from fraudlane.session import build_session


def timed(function, spark, sf_dir: str) -> float:
    started = time.perf_counter()
    function(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    queries = all_queries()
    selected = chosen.split(",") if chosen else list(queries)
    spark = build_session(cores, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    timed(queries["row_count"], spark, sf_dir)
    seconds = {}
    for name in selected:
        seconds[name] = round(timed(queries[name], spark, sf_dir), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    result = {
        "metric": "registered queries, total time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
