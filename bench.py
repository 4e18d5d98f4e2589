"""Benchmark: headline lineage queries on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query's full plan runs into Spark's ``noop`` sink (no driver collect);
one warm-up query runs first. Prints ONE JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventweave.plans.queries import QUERIES  # noqa: E402
from eventweave.session import local_session  # noqa: E402

HEADLINE = [
    "events_unified",     # adapter: orders x customer x geo, lineitem fan-out
    "gate_outcome",       # snapshot gate (one aggregate per run)
    "task_chain",         # flagship: gate + ordered scan per run
    "prefix_replay",      # arrival-order replay with running counts
    "envelope_decode",    # encode + decode every event (JSON, base64)
    "dataset_profile",    # 14 datasets profiled (rows, bytes)
    "mce_stream",         # full lineage -> ordered change events
    "lineage_edges",      # dataset/task edges
    "schema_history",     # catalog naming + per-table version scan
]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) * 2)
    run(spark, "gate_outcome", sf_dir)  # warm-up: JVM, codegen caches, file listing
    times = {}
    for name in names:
        times[name] = round(statistics.median(run(spark, name, sf_dir) for _ in range(reps)), 3)
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    try:
        sf_val = float(sf)
    except ValueError:
        sf_val = sf
    print(json.dumps({"metric": "lineage_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf_val, "cpus": int(cpus),
                      "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
