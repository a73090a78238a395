"""Time every registered query on local[$BENCH_CPUS] over $BENCH_SF_DIR and print one JSON line.

Each query runs once to warm up, then RUNS times into the noop sink; its time is the median. The time
covers planning and every intermediate table the query writes.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from scholarmill.plans.catalogue import REGISTRY  # noqa: E402
from scholarmill.session import local_session  # noqa: E402

RUNS = 3


def timed(fn, spark, folder: str) -> float:
    start = time.perf_counter()
    fn(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "scholarmill-bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, fn in REGISTRY.items():
        timed(fn, spark, folder)
        seconds[name] = round(statistics.median(timed(fn, spark, folder) for _ in range(RUNS)), 3)
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
