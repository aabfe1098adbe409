"""bench.py prints exactly one JSON line with the driver's fields."""

import json
import os
import subprocess
import sys

from .conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_MEM="1g")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "driver_standings", "top10_drivers"],
                         capture_output=True, text=True, env=env, timeout=600, cwd=ROOT)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert out.returncode == 0 and len(lines) == 1, out.stderr[-2000:]
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and set(rec["queries"]) == {"driver_standings", "top10_drivers"}
    assert "failed" not in rec
    assert abs(rec["value"] - sum(rec["queries"].values())) < 0.01
