"""Benchmark: run every catalogued query at $BENCH_SF_DIR on
local[$BENCH_CPUS] and print one JSON line.

Each query is executed to completion with the ``noop`` sink (the full plan
runs, nothing is collected to the driver), ``$BENCH_REPEAT`` times (default
2); the per-query figure is the best run (warm JVM, compiled code), the
first-run figures are reported as ``cold``.  ``value`` is the sum of the
per-query best times in seconds.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starkit.plans.catalog import QUERIES  # noqa: E402
from starkit.session import get_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    # Warm-up (JVM, class loading, file listing cache) outside the timings.
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.format("noop").mode("overwrite").save()

    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in sorted(QUERIES):
        if only and name not in only:
            continue
        runs = []
        try:
            for _ in range(repeat):
                t0 = time.perf_counter()
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - t0)
        except Exception as exc:  # noqa: BLE001 - one failing query must not hide the others
            failed[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
            print(f"{name:34s} FAILED {failed[name]}", file=sys.stderr, flush=True)
            continue
        times[name], cold[name] = round(min(runs), 3), round(runs[0], 3)
        print(f"{name:34s} {times[name]:8.3f}s  (cold {cold[name]:.3f}s)", file=sys.stderr, flush=True)

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "catalogue_total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "cold": cold,
        "cold_total": round(sum(cold.values()), 3),
        "failed": failed,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
