import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="top_n,dim_calendar")
    out = subprocess.run([sys.executable, "bench.py"], cwd=ROOT, env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    result = json.loads(out[0])
    assert result["unit"] == "sec" and result["sf"] == "0.001"
    assert set(result["queries"]) == {"top_n", "dim_calendar"}
    assert result["value"] == round(sum(result["queries"].values()), 3) or \
        abs(result["value"] - sum(result["queries"].values())) < 0.01
