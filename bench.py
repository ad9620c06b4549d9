"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced with a ``noop`` write (full execution, nothing collected
to the driver).  A short warm-up runs first; then every query runs
``BENCH_REPEAT`` times (default 1) and the median is reported.  Prints ONE
JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkfold.plans import REGISTRY  # noqa: E402
from sparkfold.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(2 * cpus, 8),
                          extra={"spark.sql.files.maxPartitionBytes": str(64 << 20)})
    names = [n for n, e in REGISTRY.items() if e.bench and (not only or n in only)]

    def run(name: str) -> float:
        t0 = time.perf_counter()
        REGISTRY[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("retweet_counts")                       # JVM warm-up
    spark.range(0, 1000, numPartitions=cpus).mapInPandas(lambda it: it, "id long") \
        .write.format("noop").mode("overwrite").save()      # Python worker warm-up
    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for n in names:
        try:
            times[n] = round(statistics.median(run(n) for _ in range(repeat)), 3)
        except Exception as ex:  # noqa: BLE001 - report and keep going
            failed[n] = f"{type(ex).__name__}: {str(ex)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "cpus": cpus, "n_queries": len(times)}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
