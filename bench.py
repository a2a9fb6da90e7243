"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line.

Each query is executed in full through the ``noop`` sink (every row is
produced, nothing is collected to the driver), twice; the faster (warm) run
is the sum of per-query times.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillsight.registry import queries  # noqa: E402
from tillsight.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = set(sys.argv[1:])
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.local.dir": tempfile.mkdtemp(prefix="tillsight-bench-")})
    qs = {k: v for k, v in queries().items() if not only or k in only}
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    times = {}
    for name, fn in qs.items():
        best = None
        for _ in range(runs):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "runs": runs, "stat": "min"}))


if __name__ == "__main__":
    main()
