"""Streaming forms: batch = stream for several micro-batch cuts, late data
with exact batches, state read-back and recovery on one checkpoint."""

from __future__ import annotations

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowlab.operators import count_trigger, count_window, count_window_list, rolling_sum
from flowlab.sources.tables import directory_stream
from flowlab.streaming.operators import (PANDAS_STATE, TRANSFORM_WITH_STATE, count_trigger_stream,
                                         count_window_stream, read_state, rolling_stream, session_agg_stream,
                                         with_event_time)
from flowlab.streaming.runner import (LATE_PARITY_CONF, SESSION_CONF, STATEFUL_CONF, StreamRun, path_exists)


def land(folder, batches, columns, start=0):
    """Write one parquet file per batch with increasing modification times,
    so a file stream with ``maxFilesPerTrigger=1`` reads them in order."""
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(batches, start=start):
        p = os.path.join(folder, f"b{i:05d}.parquet")
        pd.DataFrame(rows, columns=columns).to_parquet(p, index=False)
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))


def keyed_numbers():
    # keys with 9, 10, 11 and 20 values; seq is the arrival order
    rows, seq = [], 0
    for key, n in ((1, 9), (2, 10), (3, 11), (4, 20)):
        for j in range(n):
            rows.append((seq, key, (key * 100 + j) * 3))
            seq += 1
    # interleave keys the way a stream would
    rows.sort(key=lambda r: (r[2] % 7, r[0]))
    return [(i, k, v) for i, (_s, k, v) in enumerate(rows)]


def cut(rows, parts):
    size = -(-len(rows) // parts)
    return [rows[i:i + size] for i in range(0, len(rows), size)]


def _schema(spark, columns, rows):
    return spark.createDataFrame(pd.DataFrame(rows, columns=columns)).schema


@pytest.mark.parametrize("parts,engine", [(1, PANDAS_STATE), (3, PANDAS_STATE), (11, PANDAS_STATE),
                                          (3, TRANSFORM_WITH_STATE), (11, TRANSFORM_WITH_STATE)])
def test_count_window_stream_equals_batch(spark, tmp_path, parts, engine):
    rows = keyed_numbers()
    cols = ["seq", "key", "value"]
    land(str(tmp_path / "in"), cut(rows, parts), cols)
    schema = _schema(spark, cols, rows)
    src = directory_stream(spark, str(tmp_path / "in"), schema, max_files_per_trigger=1)
    q = count_window_stream(src, "key", "seq", "value", 10, with_values=True, engine=engine)
    run = StreamRun(spark, "cw")
    run.run(q, "append", STATEFUL_CONF)
    got = run.result(q.schema)
    batch = count_window_list(spark.createDataFrame(pd.DataFrame(rows, columns=cols)), "key", "seq", "value", 10)
    norm = lambda df: sorted((r["key"], r["window_no"], r["values"], r["total"]) for r in df.collect())  # noqa
    assert norm(got) == norm(batch)
    # emissions per key: 0, 1, 1, 2
    per_key = {k: 0 for k in (1, 2, 3, 4)}
    for r in got.collect():
        per_key[r["key"]] += 1
    assert per_key == {1: 0, 2: 1, 3: 1, 4: 2}
    assert all(r["values"].startswith(" ") and len(r["values"].split()) == 10 for r in got.collect())
    # leftovers read from the state store: 9, 0, 1, 0
    st = read_state(spark, run.checkpoint, "cnt" if engine == TRANSFORM_WITH_STATE else None)
    left = {r["key"]["key"]: r["value"]["count"] for r in st.collect()}
    assert left == {1: 9, 2: 0, 3: 1, 4: 0}


@pytest.mark.parametrize("parts,engine", [(1, PANDAS_STATE), (4, PANDAS_STATE), (4, TRANSFORM_WITH_STATE)])
def test_count_trigger_and_rolling_stream_equal_batch(spark, tmp_path, parts, engine):
    rows = [(seq, key, v, f"t{key}-{seq}") for seq, key, v in keyed_numbers()]
    cols = ["seq", "key", "value", "tag"]
    land(str(tmp_path / "in"), cut(rows, parts), cols)
    schema = _schema(spark, cols, rows)
    static = spark.createDataFrame(pd.DataFrame(rows, columns=cols))

    src = directory_stream(spark, str(tmp_path / "in"), schema, max_files_per_trigger=1)
    run = StreamRun(spark, "ct")
    q = count_trigger_stream(src, "key", "seq", "value", 5, "tag", engine=engine)
    run.run(q, "append", STATEFUL_CONF)
    got = sorted((r["key"], r["seq"], r["n"], r["total"], r["first_tag"]) for r in run.result(q.schema).collect())
    exp = sorted((r["key"], r["seq"], r["n"], r["total"], r["first_tag"])
                 for r in count_trigger(static, "key", "seq", "value", 5, carry=["tag"]).collect())
    assert got == exp

    run2 = StreamRun(spark, "roll")
    q2 = rolling_stream(src, "key", "seq", "value", "tag", emit="row", engine=engine)
    run2.run(q2, "append", STATEFUL_CONF)
    got2 = sorted((r["key"], r["seq"], r["sum"], r["first_tag"]) for r in run2.result(q2.schema).collect())
    exp2 = sorted((r["key"], r["seq"], r["s"], r["first_tag"])
                  for r in rolling_sum(static, "key", "seq", "value", carry=["tag"], name="s").collect())
    assert got2 == exp2


def _sessions_run(spark, tmp_path, batches, cols, keys, gap, delay):
    land(str(tmp_path / "in"), batches, cols)
    schema = _schema(spark, cols, [r for b in batches for r in b])
    src = directory_stream(spark, str(tmp_path / "in"), schema, max_files_per_trigger=1)
    ev = with_event_time(src, "ts_ms", "et", delay, millis=True)
    q = session_agg_stream(ev, "et", gap, {"total": F.sum("value")}, keys=keys)
    run = StreamRun(spark, "late")
    run.run(q, "append", {**SESSION_CONF, **LATE_PARITY_CONF})
    dropped = sum(op.get("numRowsDroppedByWatermark", 0) for p in run.last_progress
                  for op in p["stateOperators"])
    rows = run.result(q.schema).collect() if path_exists(spark, run.out) else []
    return rows, dropped


def test_late_row_dropped(spark, tmp_path):
    batches = [[(1000, 1), (2000, 2)], [(30000, 4)], [(3000, 8), (40000, 16)]]
    rows, dropped = _sessions_run(spark, tmp_path, batches, ["ts_ms", "value"], None, "10 seconds",
                                  "3500 milliseconds")
    got = [(r["session_start"].timestamp(), r["session_end"].timestamp(), r["total"]) for r in rows]
    assert got == [(1.0, 12.0, 3)]
    assert dropped == 1


def test_late_row_that_would_bridge_is_dropped(spark, tmp_path):
    batches = [[("A", 10000, 1), ("A", 15000, 2)], [("B", 20000, 4)], [("A", 9000, 8)], [("B", 90000, 16)]]
    rows, dropped = _sessions_run(spark, tmp_path, batches, ["k", "ts_ms", "value"], ["k"], "10 seconds",
                                  "0 seconds")
    got = sorted((r["k"], r["session_start"].timestamp(), r["session_end"].timestamp(), r["total"]) for r in rows)
    assert got == [("A", 10.0, 25.0, 3), ("B", 20.0, 30.0, 4)]
    assert dropped == 1


def test_recovery_on_one_checkpoint(spark, tmp_path):
    """Stop after part of the input, restart on the same checkpoint: the
    output equals an uninterrupted run (K6)."""
    rows = keyed_numbers()
    cols = ["seq", "key", "value"]
    batches = cut(rows, 5)
    schema = _schema(spark, cols, rows)
    folder = str(tmp_path / "in")
    land(folder, batches[:2], cols)
    run = StreamRun(spark, "recover")

    def query():
        src = directory_stream(spark, folder, schema, max_files_per_trigger=1)
        return count_window_stream(src, "key", "seq", "value", 10)

    run.run(query(), "append", STATEFUL_CONF)
    first = run.result(query().schema).count()
    land(folder, batches[2:], cols, start=2)
    run.run(query(), "append", STATEFUL_CONF)
    got = sorted((r["key"], r["window_no"], r["total"]) for r in run.result(query().schema).collect())
    exp = sorted((r["key"], r["window_no"], r["total"]) for r in
                 count_window(spark.createDataFrame(pd.DataFrame(rows, columns=cols)), "key", "seq", "value",
                              10).collect())
    assert got == exp and first <= len(exp)
    # a run without new data emits nothing new
    run.run(query(), "append", STATEFUL_CONF)
    assert run.result(query().schema).count() == len(exp)
