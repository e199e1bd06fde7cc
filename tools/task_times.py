"""Largest vs median task time per labelled run, from Spark's event log.

Runs the hot-key running sum (see ``skew_experiment.py``) with the event
log written to a scratch folder, labels each run with a job description,
and prints, per run, the slowest task and the median task of the stage
holding the slowest task.  This shows the straggler directly instead of
inferring it from wall-clock totals.

    python tools/task_times.py /tmp/run-xyz/events_x100 $(mktemp -d /tmp/run-XXXXXX)
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from flowlab.operators.prefix import AUTO, running  # noqa: E402
from flowlab.session import get_session  # noqa: E402


def main(data: str, log_dir: str) -> None:
    spark = get_session("local[8]", shuffle_partitions=16,
                        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir})
    base = spark.read.parquet(data)
    keys = {"third": F.when(F.col("user_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")),
            "single": F.lit(0).cast("bigint")}
    for name, key in keys.items():
        df = base.select("event_id", key.alias("k"), F.round(F.col("value") * 100).cast("bigint").alias("c"))
        for label, width in (("plain_window", None), ("skew_split", AUTO)):
            spark.sparkContext.setJobDescription(f"{name}/{label}")
            running(df, "k", "event_id", {"s": ("sum", F.col("c"))}, chunk_width=width) \
                .write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    spark.stop()

    print(json.dumps(summarise(log_dir), indent=1))


def _lines(path: str):
    if path.endswith(".zstd"):
        import io

        import zstandard
        with open(path, "rb") as raw:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
    else:
        with open(path) as f:
            yield from f


def summarise(log_dir: str) -> dict:
    stage_label, tasks = {}, {}
    for path in glob.glob(f"{log_dir}/**/events_*", recursive=True) + glob.glob(f"{log_dir}/*local-*"):
        if os.path.isdir(path):
            continue
        for line in _lines(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                label = (ev.get("Properties") or {}).get("spark.job.description")
                for sid in ev.get("Stage IDs", []):
                    stage_label[sid] = label
            elif kind == "SparkListenerTaskEnd":
                info = ev["Task Info"]
                tasks.setdefault(ev["Stage ID"], []).append(info["Finish Time"] - info["Launch Time"])
    out = {}
    for sid, durs in tasks.items():
        label = stage_label.get(sid)
        if not label:
            continue
        cur = out.get(label)
        if cur is None or max(durs) > cur["slowest_task_ms"]:
            out[label] = {"slowest_task_ms": max(durs), "median_task_ms_same_stage": statistics.median(durs),
                          "tasks_in_stage": len(durs)}
    return out


if __name__ == "__main__":
    if sys.argv[1] == "--parse-only":
        print(json.dumps(summarise(sys.argv[2]), indent=1))
    else:
        main(sys.argv[1], sys.argv[2])
