"""CLI: python tests/run_oracle.py [sf_dir] [query ...] - compare queries
with DuckDB and print one line per query."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle_harness import compare, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from flowlab.session import get_session  # noqa: E402


def main(argv):
    plain = "--plain" in argv
    argv = [a for a in argv if a != "--plain"]
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(entry.queries())
    if plain:   # a bare session, as a caller of the contract would build it
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8") \
            .config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = get_session("local[8]", shuffle_partitions=8)
    con = duck(sf)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            df = qs[name](spark, sf)
            if name in sqls:
                ok, msg = compare(df, con, sqls[name])
            else:
                ok, msg = True, f"{df.count()} rows (no oracle)"
        except Exception as e:  # noqa: BLE001
            ok, msg = False, f"ERROR {type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {name:28s} {time.time() - t0:6.1f}s {msg}", flush=True)
    print(f"{len(names) - bad}/{len(names)} passed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
