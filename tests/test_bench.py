"""The benchmark's line over a few queries of the smallest tables."""

import json
import os
import subprocess
import sys

from conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_line_of_json():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_RUNS="1")
    done = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "city_order_total", "stream_csv_orders"],
                          capture_output=True, text=True, env=env, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    line = json.loads(done.stdout.strip().splitlines()[-1])
    assert line["value"] > 0 and line["queries"]["city_order_total"] > 0
    assert line["streams"]["stream_csv_orders"] > 0 and len(line["calibration"]) == 3
    assert line["sf"] == 0.001
