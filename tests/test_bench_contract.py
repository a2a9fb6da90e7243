"""bench.py prints one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_RUNS="1")
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py"), "get_customers", "get_cohort_matrix"],
                         capture_output=True, text=True, env=env, timeout=600, check=True)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    record = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(record)
    assert record["unit"] == "sec" and set(record["queries"]) == {"get_customers", "get_cohort_matrix"}
    assert record["value"] > 0 and record["sf"] == "0.001"
