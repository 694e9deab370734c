"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

per query, each written to the ``noop`` sink (full execution, no output
cost). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabsmith.plans.catalog import QUERIES  # noqa: E402
from tabsmith.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = os.environ.get("BENCH_QUERIES")
    keys = [k for k in QUERIES if not only or k in only.split(",")]
    n = int(cpus) if cpus.isdigit() else os.cpu_count()
    spark = build_session(f"local[{cpus}]", shuffle_partitions=2 * n,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    times: dict[str, float] = {}
    for k in keys:
        fn = QUERIES[k]
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[k] = round(statistics.median(samples), 3)
        if os.environ.get("BENCH_VERBOSE"):
            print(f"# {k}: {times[k]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": n, "runs": runs,
                      "shuffle_partitions": 2 * n}))
    spark.stop()


if __name__ == "__main__":
    main()
