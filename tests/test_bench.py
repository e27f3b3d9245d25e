"""bench.py prints one JSON line with the expected fields."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_REPEAT="1",
               BENCH_QUERIES="funnel_dropoff,customer_spend")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and set(d["queries"]) == {"funnel_dropoff", "customer_spend"}
    assert d["value"] == round(sum(d["queries"].values()), 3)


def test_query_cli_writes_result(tmp_path):
    out = tmp_path / "funnel"
    r = subprocess.run([sys.executable, "-m", "tidemark.plans.registry", "funnel_dropoff",
                        "--sf-dir", "/root/testdata/sf0.001", "--out", str(out), "--master", "local[2]"],
                       cwd=ROOT, capture_output=True, text=True, timeout=600)
    assert r.returncode == 0, r.stderr[-2000:]
    assert "funnel_dropoff: 5 rows written" in r.stdout
