"""bench.py prints one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_DRIVER_MEM="2g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "a1_rate_more_movies", "x4_fuzzy_genre"],
                         capture_output=True, text=True, env=env, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == "0.001" and rec["metric"]
    assert set(rec["queries"]) == {"a1_rate_more_movies", "x4_fuzzy_genre"}
    assert abs(rec["value"] - sum(rec["queries"].values())) < 0.01
