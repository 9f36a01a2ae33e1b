import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(tmp_dir):
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_RUNS="1",
               BENCH_PIPELINE="0", BENCH_QUERIES="lambda_orders,gold_sales_by_region")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], cwd=tmp_dir, env=env,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["metric"] == "total_median_sec" and rec["unit"] == "sec" and rec["sf"] == 0.001
    assert set(rec["queries"]) == {"lambda_orders", "gold_sales_by_region"}
    assert abs(rec["value"] - sum(rec["queries"].values())) < 1e-6
