"""bench.py prints exactly one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

import pytest

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": SF, "BENCH_CPUS": "4"}
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=900, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    d = json.loads(out[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and d["value"] > 0
    assert d["year_sum_partitions_scanned"]["year_sum_range_partitioned"] < d["year_sum_partitions_scanned"]["of"]
    import __spark_entry__ as E
    assert set(E.queries()) <= set(d["queries"])
