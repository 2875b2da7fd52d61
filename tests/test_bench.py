"""bench.py prints exactly one JSON line on stdout with the driver's keys."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL


def test_bench_single_json_line(tmp_dir):
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2")
    res = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py"), "top_names_per_day", "board_100"],
        cwd=tmp_dir, env=env, capture_output=True, text=True, timeout=600,
    )
    lines = [ln for ln in res.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1, res.stdout + res.stderr[-2000:]
    out = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(out)
    assert out["unit"] == "sec" and out["sf"] == 0.001
    assert set(out["queries"]) == {"top_names_per_day", "board_100"}
    assert abs(out["value"] - sum(out["queries"].values())) < 0.01
