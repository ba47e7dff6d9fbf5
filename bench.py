"""Benchmark: every registered query on the driver tables.

Runs each query of ``immolens.plans.catalog`` on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]``. Each query is executed
into the ``noop`` sink (the whole plan runs, nothing is collected to the
driver); one warm-up run, then the median of ``$BENCH_RUNS`` timed runs.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from immolens.plans.catalog import QUERIES  # noqa: E402
from immolens.session import local_session  # noqa: E402


def run_once(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    cores = int(cpus) if cpus.isdigit() else 8
    spark = local_session(cpus, shuffle_partitions=max(cores, 1) * 2, app_name="immolens-bench")

    times = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        run_once(spark, fn, sf_dir)                                # warm-up
        times[name] = round(statistics.median(run_once(spark, fn, sf_dir) for _ in range(runs)), 4)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
