"""Measure the prefix scan on a hot key: plain window vs skew-split.

Builds (once, in a scratch folder) ``copies`` shifted copies of the events
table and times a running sum into the noop sink with ``chunk_width=None``
(plain window) and the default (measured, split), best of three, for two
key layouts: a third of all rows on one key, and every row on one key.
Prints one JSON line.

    python tools/skew_experiment.py /root/testdata/sf0.1 20 /tmp/run-xyz
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from flowlab.operators.prefix import AUTO, plan_chunks, running  # noqa: E402
from flowlab.session import get_session  # noqa: E402


def main(sf_dir: str, copies: int, scratch: str) -> None:
    spark = get_session("local[8]", shuffle_partitions=16)
    path = f"{scratch}/events_x{copies}"
    if not os.path.exists(path):
        ev = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "value")
        n = ev.count()
        # shifted copies: event_id stays unique and increasing per copy
        parts = [ev.withColumn("event_id", F.col("event_id") + F.lit(i * n)) for i in range(copies)]
        big = parts[0]
        for p in parts[1:]:
            big = big.unionByName(p)
        big.repartition(32).write.parquet(path)
    base = spark.read.parquet(path)
    keys = {
        "third": F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")),  # 1/3 on key 0
        "single": F.lit(0).cast("bigint"),                                                  # all rows
    }
    out = {"rows": base.count()}
    for name, key in keys.items():
        df = base.select("event_id", key.alias("k"), F.round(F.col("value") * 100).cast("bigint").alias("c"))
        plan = plan_chunks(df, "k", "event_id")
        out[f"{name}_points"], out[f"{name}_hot_keys"] = sum(map(len, plan.points or ())), len(plan.hot or ())
        best = {"plain_window": [], "skew_split": []}
        for _ in range(3):
            for label, width in (("plain_window", None), ("skew_split", AUTO)):
                t0 = time.perf_counter()
                running(df, "k", "event_id", {"s": ("sum", F.col("c"))}, chunk_width=width) \
                    .write.format("noop").mode("overwrite").save()
                best[label].append(time.perf_counter() - t0)
        for label, ts in best.items():
            out[f"{name}_{label}_best_of_3"] = round(min(ts), 3)
    print(json.dumps(out))


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]), sys.argv[3])
