"""bench.py prints exactly one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys

from .conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_RUNS="1", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True, text=True,
                         timeout=900)
    lines = [x for x in out.stdout.splitlines() if x.strip()]
    assert len(lines) == 1, (out.stdout[-2000:], out.stderr[-2000:])
    rec = json.loads(lines[0])
    assert rec["unit"] == "sec" and rec["sf"] == 0.001 and rec["value"] > 0
    assert set(rec["queries"]) == {"tx_attributed", "transfers_attributed", "daily_metrics", "upsert_delete_insert"}
