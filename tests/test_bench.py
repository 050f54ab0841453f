"""bench.py keeps its contract: one JSON line with metric, value, unit, queries, sf."""

import json
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(smoke_dir):
    env = dict(os.environ, BENCH_SF_DIR=smoke_dir, BENCH_REPEAT="1", BENCH_CPUS="4")
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], env=env, cwd=REPO,
                         capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [l for l in out.stdout.splitlines() if l.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result)
    assert result["unit"] == "sec" and result["sf"] == "0.001"
    assert abs(result["value"] - sum(result["queries"].values())) < 1e-6 * max(1.0, result["value"]) + 0.01
    assert "mart_daily_sales" in result["queries"] and "warehouse_build" in result["queries"]
