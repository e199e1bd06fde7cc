"""Line streams (S2), file sinks (S8), restarts (K7), processing time (T6),
and an exclusion list that changes between micro-batches (J5)."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from flowlab.functions.parse import parse_fields
from flowlab.operators import count_window
from flowlab.session import scratch_path
from flowlab.sources.sinks import stream_to_files
from flowlab.sources.text import line_stream
from flowlab.streaming.operators import (count_window_stream, exclude_per_batch, processing_time,
                                         window_agg_stream)
from flowlab.streaming.runner import (STATEFUL_CONF, StreamRun, read_back, run_with_restarts, scoped_conf,
                                      versioned_writer)


def write_lines(folder, name, lines, t):
    os.makedirs(folder, exist_ok=True)
    p = os.path.join(folder, name)
    with open(p, "w") as f:
        f.write("\n".join(lines) + "\n")
    os.utime(p, (t, t))


def test_line_stream_count_window_and_text_sink(spark, tmp_path):
    folder = str(tmp_path / "lines")
    lines = [f"{k},{k * 10 + i}" for i in range(12) for k in (1, 2)]   # arrival order = file order
    for j in range(3):
        write_lines(folder, f"f{j}.txt", lines[j * 8:(j + 1) * 8], 1_700_000_000 + j)
    src = line_stream(spark, folder, max_files_per_trigger=1)
    # a stream has no line number; the value itself is increasing here
    kn = parse_fields(src, "keyed_number").withColumn("o", F.col("value"))
    out, ck = scratch_path(spark, "txt"), scratch_path(spark, "txt-ck")
    with scoped_conf(spark, STATEFUL_CONF):
        q = stream_to_files(count_window_stream(kn, "key", "o", "value", 10).select("key", "window_no", "total"),
                            out, ck, fmt="text", max_records_per_file=1)
        q.awaitTermination()
    got = sorted(r.value for r in spark.read.text(out).collect())
    assert got == ["(1,0,145)", "(2,0,245)"]


def test_restarts_after_failures(spark, tmp_path):
    """K7: the sink fails on its first two attempts; the query is restarted on
    the same checkpoint and the replayed batch is written exactly once."""
    folder = str(tmp_path / "in")
    write_lines(folder, "a.txt", [f"{i % 3},{i}" for i in range(30)], 1_700_000_000)
    out, ck = scratch_path(spark, "k7"), scratch_path(spark, "k7-ck")
    attempts = {"n": 0}
    write = versioned_writer(out)

    def flaky(df, batch_id):
        attempts["n"] += 1
        if attempts["n"] <= 2:
            raise RuntimeError("injected sink failure")
        write(df, batch_id)

    def start():
        src = parse_fields(line_stream(spark, folder), "keyed_number")
        return src.writeStream.foreachBatch(flaky).option("checkpointLocation", ck) \
            .trigger(availableNow=True).start()

    run_with_restarts(start, attempts=3, delay_s=0.1)
    assert attempts["n"] == 3
    assert read_back(spark, out, None, "update", keys=["key", "value"]).count() == 30
    with pytest.raises(Exception):
        attempts["n"] = -10   # fails more often than the strategy allows
        run_with_restarts(lambda: _fresh_failing(spark, folder), attempts=1, delay_s=0.0)


def _fresh_failing(spark, folder):
    def boom(df, batch_id):
        raise RuntimeError("always fails")
    src = parse_fields(line_stream(spark, folder), "keyed_number")
    return src.writeStream.foreachBatch(boom).option("checkpointLocation", scratch_path(spark, "boom")) \
        .trigger(availableNow=True).start()


def test_processing_time_windows_conserve_rows(spark, tmp_path):
    folder = str(tmp_path / "in")
    write_lines(folder, "a.txt", [f"{i % 4},{i}" for i in range(40)], 1_700_000_000)
    src = processing_time(parse_fields(line_stream(spark, folder), "keyed_number"), "pt")
    agg = window_agg_stream(src, "pt", "2 seconds", "1 second", {"total": F.sum("value"), "n": F.count("*")},
                            keys=["key"])
    run = StreamRun(spark, "ptw")
    run.run(agg, "update")
    res = run.result(agg.schema, "update", keys=["key", "window_start"])
    # sliding 2 s / 1 s: every row lands in exactly two windows
    assert res.agg(F.sum("n")).first()[0] == 80
    assert res.agg(F.sum("total")).first()[0] == 2 * sum(range(40))


def test_exclusion_list_changing_between_batches(spark, tmp_path):
    folder, lst = str(tmp_path / "in"), str(tmp_path / "exclude")
    spark.createDataFrame([(1,)], "key long").write.parquet(f"{lst}/v0")
    write_lines(folder, "a.txt", ["1,1", "2,2", "3,3"], 1_700_000_000)
    out, ck = scratch_path(spark, "j5"), scratch_path(spark, "j5-ck")
    fn = exclude_per_batch(lambda: spark.read.option("recursiveFileLookup", "true").parquet(lst), "key",
                           versioned_writer(out))

    def start():
        src = parse_fields(line_stream(spark, folder), "keyed_number")
        return src.writeStream.foreachBatch(fn).option("checkpointLocation", ck).trigger(availableNow=True).start()

    start().awaitTermination()
    spark.createDataFrame([(2,)], "key long").write.parquet(f"{lst}/v1")   # the list grows
    write_lines(folder, "b.txt", ["1,4", "2,5", "4,6"], 1_700_000_001)
    start().awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("key", "value").collect())
    # key 2 was kept before it was listed, dropped after
    assert got == [(2, 2), (3, 3), (4, 6)]


def test_count_window_batch_on_parsed_lines(spark, tmp_path):
    folder = str(tmp_path / "in")
    write_lines(folder, "a.txt", [f"7,{i}" for i in range(25)], 1_700_000_000)
    kn = parse_fields(spark.read.text(folder).withColumn("seq", F.monotonically_increasing_id()),
                      "keyed_number", keep=["seq"])
    got = sorted((r.window_no, r.total) for r in count_window(kn, "key", "seq", "value", 10).collect())
    assert got == [(0, 45), (1, 145)]
