"""bench.py prints one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2",
               BENCH_QUERIES="agg_sum_key,join_ss_risk")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True)
    lines = [x for x in out.stdout.splitlines() if x.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and not d["failed"]
    assert set(d["queries"]) == {"feeds", "agg_sum_key", "join_ss_risk"}
    assert d["value"] == round(sum(d["queries"].values()), 3)
