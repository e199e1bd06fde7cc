"""The driver contract: bench.py prints one JSON line with the required
fields (the query/oracle pairing is checked in test_oracle.py)."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from conftest import REPO, SF_SMALL


def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": SF_SMALL, "BENCH_CPUS": "2", "BENCH_QUERIES": "group_sum,tumbling"}
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    res = json.loads(out[0])
    assert res["unit"] == "sec" and res["sf"] == 0.001 and set(res["queries"]) == {"group_sum", "tumbling"}
    assert abs(res["value"] - sum(res["queries"].values())) < 0.01
