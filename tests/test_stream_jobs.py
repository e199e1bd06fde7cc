"""The reference's programs as stream jobs, on its own input files."""

from __future__ import annotations

import os
import shutil

from pyspark.sql import functions as F

from flowlab.plans import jobs
from flowlab.session import scratch_path
from flowlab.streaming.runner import StreamRun, STATEFUL_CONF


def _dir_with(tmp_path, src, name="in"):
    d = tmp_path / name
    d.mkdir()
    shutil.copy(src, d / os.path.basename(src))
    return str(d)


def test_word_count_stream(spark, ref_input, tmp_path):
    q = jobs.word_count_stream(spark, _dir_with(tmp_path, f"{ref_input}/wc.txt"))
    run = StreamRun(spark, "wcs")
    run.run(q, "update")
    got = {r.word: r.n for r in run.result(q.schema, "update", keys=["word"]).collect()}
    assert got == {"Nana": 2, "Nanaho": 2, "Nate": 1, "Nicole": 7, "Nipul": 6, "Nipun": 2, "Noel": 1, "Noman": 12}


def test_rolling_sales_stream(spark, ref_input, tmp_path):
    q = jobs.rolling_sales_stream(spark, _dir_with(tmp_path, f"{ref_input}/avg1.txt"))
    run = StreamRun(spark, "rss")
    run.run(q, "append", STATEFUL_CONF)
    rows = run.result(q.schema).collect()
    assert len(rows) == 18
    june = max((r for r in rows if r.month == "June"), key=lambda r: r.n)
    assert (june.n, june.sum, june.min, june.max) == (9, 232, 10, 41)
    assert (june.first_category, june.first_product) == ("Category5", "Bat")
    assert (june.argmin_product, june.argmax_product) == ("Perfume", "Bat")   # first of the tied 41s


def test_average_profit_and_count_trigger_stream(spark, ref_input, tmp_path):
    d = _dir_with(tmp_path, f"{ref_input}/avg.txt")
    q = jobs.average_profit_stream(spark, d)
    run = StreamRun(spark, "aps")
    run.run(q, "append", STATEFUL_CONF)
    rows = run.result(q.schema).collect()
    assert len(rows) == 258
    assert {r.avg_profit for r in rows} >= {2336 / 82, 2577 / 81, 3175 / 95}
    q2 = jobs.sales_count_trigger_stream(spark, d, 5)
    run2 = StreamRun(spark, "cts")
    run2.run(q2, "append", STATEFUL_CONF)
    fired = {}
    for r in run2.result(q2.schema).collect():
        fired.setdefault(r.month, []).append(r.total)
    assert {m: len(v) for m, v in fired.items()} == {"June": 16, "July": 16, "August": 19}
    assert max(fired["June"]) == 2275 and max(fired["August"]) == 3175


def test_department_count_stream(spark, ref_input, tmp_path):
    q = jobs.department_count_stream(spark, _dir_with(tmp_path, f"{ref_input}/broadcast.txt"),
                                     f"{ref_input}/broadcast_small.txt")
    run = StreamRun(spark, "dcs")
    run.run(q, "append", STATEFUL_CONF)
    res = run.result(q.schema)
    assert res.count() == 399
    last = {r.dept: r.m for r in res.groupBy("dept").agg(F.max("n").alias("m")).collect()}
    assert last == {"Development": 59, "Finance": 60, "Marketing": 59, "Production": 52, "Purchase": 64,
                    "Safety": 58, "Stores": 47}


def test_split_numbers_stream(spark, ref_input, tmp_path):
    out = scratch_path(spark, "split")
    q = jobs.split_numbers_stream(spark, _dir_with(tmp_path, f"{ref_input}/oddeven.txt"), out,
                                  scratch_path(spark, "split-ck"))
    q.awaitTermination()
    assert spark.read.parquet(f"{out}/even").count() == 24
    assert spark.read.parquet(f"{out}/odd").count() == 19


def test_keyed_sum_and_readings_stream(spark, tmp_path):
    d = tmp_path / "kn"
    d.mkdir()
    (d / "a.txt").write_text("".join(f"{k},{i}\n" for i in range(20) for k in (1, 2)))
    q = jobs.keyed_sum_stream(spark, str(d), 10, with_values=True)
    out, ck = scratch_path(spark, "ks"), scratch_path(spark, "ks-ck")
    jobs.run_stream_job(q, out, ck, fmt="parquet", stateful=True).awaitTermination()
    got = sorted((r.key, r.window_no, r.total, r["values"]) for r in spark.read.parquet(out).collect())
    assert [g[:3] for g in got] == [(1, 0, 45), (1, 1, 145), (2, 0, 45), (2, 1, 145)]
    assert got[0][3] == " 0 1 2 3 4 5 6 7 8 9"

    r = tmp_path / "rd"
    r.mkdir()
    (r / "a.txt").write_text("0,1\n1000,2\n2001,4\n")
    q2 = jobs.readings_window_stream(spark, str(r), "session")
    run = StreamRun(spark, "rds")
    run.run(q2, "complete")
    got2 = sorted((x.session_start.timestamp(), x.session_end.timestamp(), x.total)
                  for x in run.result(q2.schema, "complete").collect())
    assert got2 == [(0.0, 2.0, 3), (2.001, 3.001, 4)]


def test_rolling_stream_batch_emit_ends_at_final_values(spark, ref_input, tmp_path):
    """R-note: ``emit="batch"`` is an update-mode aggregation (one row per key
    per micro-batch); its last version per key equals the final values."""
    from flowlab.streaming.operators import rolling_stream
    q = rolling_stream(jobs.sales_stream(spark, _dir_with(tmp_path, f"{ref_input}/avg1.txt")), "month", None,
                       "profit", [], emit="batch")
    run = StreamRun(spark, "rsb")
    run.run(q, "update")
    got = {r.month: (r.n, r.sum, r.min, r.max) for r in run.result(q.schema, "update", keys=["month"]).collect()}
    assert got == {"June": (9, 232, 10, 41), "July": (3, 89, 12, 50), "August": (6, 212, 16, 50)}


def test_sales_processing_time_windows(spark, ref_input, tmp_path):
    d = _dir_with(tmp_path, f"{ref_input}/avg.txt")
    for kind, mode, keys in (("tumbling", "update", ["month", "window_start"]),
                             ("session", "complete", ["month", "session_start"])):
        q = jobs.sales_window_stream(spark, d, kind)
        run = StreamRun(spark, f"spt-{kind}")
        run.run(q, mode)
        res = run.result(q.schema, mode, keys=keys)
        # every sale lands in exactly one tumbling window / session
        assert res.agg(F.sum("n")).first()[0] == 258
        assert res.agg(F.sum("profit")).first()[0] == 2336 + 2577 + 3175


def test_periodic_trigger_job(spark, tmp_path):
    """K6: a long-running job with a 1 s processing-time trigger; stopped
    once everything available is processed, its committed output is whole."""
    d = tmp_path / "kn"
    d.mkdir()
    (d / "a.txt").write_text("".join(f"{k},{i}\n" for i in range(30) for k in (1, 2, 3)))
    out, ck = scratch_path(spark, "k6"), scratch_path(spark, "k6-ck")
    q = jobs.run_stream_job(jobs.keyed_sum_stream(spark, str(d), 10), out, ck, fmt="parquet",
                            trigger={"processingTime": "1 second"}, stateful=True)
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    got = sorted((r.key, r.window_no, r.total) for r in spark.read.parquet(out).collect())
    assert got == [(k, w, sum(range(10 * w, 10 * w + 10))) for k in (1, 2, 3) for w in range(3)]
