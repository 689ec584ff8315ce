"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line with seconds per query: the
median of ``$BENCH_REPEATS`` (default 3) runs, after one warm-up run of
every query on the smallest tables.  Each result is fully computed with the
``noop`` sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dayload.queries import QUERIES  # noqa: E402
from dayload.session import build_session  # noqa: E402

HEADLINE = [
    "daily_load_change",    # flagship: one day by change date
    "daily_load_business",
    "daily_load_all",
    "daily_reconcile",      # business-date vs change-date load of a day
    "reconcile_counts",        # whole orders vs changed copy
    "reconcile_columns",
    "reconcile_dup_counts",    # whole lineitem, repeating keys
    "reconcile_hot_key",       # a third of lineitem on one key, mostly copies
    "reconcile_sample_unequal",
    "load_bounded_files",      # whole lineitem written in bounded files
    "project_tolerant",
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    df = QUERIES[name](spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", app="dayload-bench",
                          shuffle_partitions=int(cpus))
    # JVM, reader, writer and code-generation warm-up: every headline query
    # once on the smallest tables (same plan shapes, little data)
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for name in HEADLINE:
        run(spark, name, warm_dir if os.path.isdir(warm_dir) else sf_dir)
    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "3")))
    times = {}
    for name in HEADLINE:
        runs = sorted(run(spark, name, sf_dir) for _ in range(repeats))
        times[name] = round(runs[len(runs) // 2], 3)
    sf_name = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf: float | str = float(sf_name)
    except ValueError:
        sf = sf_name
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
