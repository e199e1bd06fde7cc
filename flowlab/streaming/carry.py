"""Keyed state on a stream as tables: one version per micro-batch.

A step gets a micro-batch and the tables the batch before left, and returns
rows for the sink and the tables to carry on.  It is ordinary DataFrame code:
running aggregates are the skew-split scans of ``operators.prefix``, with the
carried totals of a key as one more row in front of its new rows, so a hot key
is spread over tasks as in a batch job and nothing runs per key in Python.

Every table goes to a folder of its own batch id, over whatever an earlier
attempt of that batch left there, and a step reads only older versions: a
replayed batch gives the same tables again.  The state of a key is as large as
its open group, never its history.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, FractionalType, LongType, StructField, StructType

from flowlab.operators.prefix import _order_number, running
from flowlab.operators.windows import _COMBINE, _agg_exprs, merge_intervals
from flowlab.session import scratch_path
from flowlab.streaming.runner import scoped_conf

Tables = dict[str, DataFrame]
#: ``step(batch, carried, batch_id) -> (outputs, state)``
Step = Callable[[DataFrame, "Carried", int], tuple[Tables, Tables]]


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


class Carried:
    """What a step sees of its run: ``carried(name)`` is the table the batch
    before left, ``None`` in the first batch."""

    def __init__(self, run: CarryRun, batch_id: int):
        self.run, self.batch_id, self.held = run, batch_id, []

    def __call__(self, name: str) -> DataFrame | None:
        return self.run.carried(name, self.batch_id)

    def once(self, df: DataFrame) -> DataFrame:
        """``df`` kept until the batch is written: several tables are made of it."""
        self.held.append(df.persist())
        return self.held[-1]

    def release(self) -> None:
        for df in self.held:
            df.unpersist()


class CarryRun:
    """Places of one stream with carried tables: sink, state, checkpoint."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.out, self.state = scratch_path(spark, f"{name}-out"), scratch_path(spark, f"{name}-state")
        self.checkpoint = scratch_path(spark, f"{name}-checkpoint")

    def _files(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def versions(self, name: str) -> list[int]:
        """Batch ids whose table ``name`` is whole, ascending."""
        files, path = self._files(f"{self.state}/{name}")
        if not files.exists(path):
            return []
        done = (p.getPath() for p in files.listStatus(path))
        return sorted(int(p.getName().split("=")[1]) for p in done if files.exists(self._files(f"{p}/_SUCCESS")[1]))

    def carried(self, name: str, before: int | None = None) -> DataFrame | None:
        """K5: the latest version of a state table (of a batch before
        ``before``), as of the last finished micro-batch."""
        found = [v for v in self.versions(name) if before is None or v < before]
        return self.spark.read.parquet(f"{self.state}/{name}/batch={found[-1]}") if found else None

    def _drop_old(self, name: str, batch_id: int) -> None:
        for v in self.versions(name):
            if v < batch_id - 1:                    # the one before stays for a replay
                files, path = self._files(f"{self.state}/{name}/batch={v}")
                files.delete(path, True)

    def start(self, df: DataFrame, step: Step, conf: dict | None = None, trigger: dict | None = None):
        """Start ``df`` with ``step`` on every batch, until its input is used
        up or as ``trigger`` says; a new start goes on at the same checkpoint."""
        def write(batch: DataFrame, batch_id: int) -> None:
            carried = Carried(self, batch_id)
            try:
                outputs, state = step(carried.once(batch), carried, batch_id)
                for base, tables in ((self.out, outputs), (self.state, state)):
                    for name, table in tables.items():
                        table.write.mode("overwrite").parquet(f"{base}/{name}/batch={batch_id}")
                for name in state:
                    self._drop_old(name, batch_id)
            finally:
                carried.release()
        with scoped_conf(self.spark, conf):     # the query's own session keeps them
            return (df.writeStream.foreachBatch(write).option("checkpointLocation", self.checkpoint)
                    .trigger(**(trigger or {"availableNow": True})).start())

    def run(self, df: DataFrame, step: Step, conf: dict | None = None, trigger: dict | None = None):
        """``start``, and wait for the end."""
        q = self.start(df, step, conf, trigger)
        q.awaitTermination()
        return q

    def flush(self, name: str, rows: DataFrame, of: str) -> None:
        """Add ``rows``, made of the carried table ``of``, to output ``name``
        at the end of a bounded input.  They take the place of the batch that
        did not come, so flushing again changes nothing."""
        last = self.versions(of)
        if last:
            rows.write.mode("overwrite").parquet(f"{self.out}/{name}/batch={last[-1] + 1}")

    def result(self, name: str, schema: StructType | str) -> DataFrame:
        files, path = self._files(f"{self.out}/{name}")
        if not files.exists(path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.option("basePath", f"{self.out}/{name}").parquet(f"{self.out}/{name}").drop("batch")


def _summed(df: DataFrame, value: str) -> Column:
    """``value`` in the type its sums have: fractions stay fractions."""
    kind = df.schema[value].dataType
    if isinstance(kind, DecimalType):
        return F.col(value).cast(DecimalType(38, kind.scale))
    return F.col(value).cast("double" if isinstance(kind, FractionalType) else "bigint")


def _front(carried: DataFrame | None, rows: DataFrame, order: str) -> DataFrame:
    """``rows`` with the carried rows in front: a null order sorts first."""
    rows = rows.withColumn("_fl_seed", F.lit(False))
    if carried is None:
        return rows
    kind = rows.schema[order].dataType
    return rows.unionByName(carried.withColumns({order: F.lit(None).cast(kind), "_fl_seed": F.lit(True)}), allowMissingColumns=True)


def _as_text(values: str) -> Column:
    """Collected ``(position, value)`` as ``" v1 v2 ..."``."""
    return F.concat(F.lit(" "), F.concat_ws(" ", F.transform(F.array_sort(values), lambda x: x["v"].cast("string"))))


def rolling_carry(keys, order: str, value: str, cols=(), every: int | None = None) -> Step:
    """R1-R8 on a stream, one row per input row: running ``n, sum, min, max``
    of ``value``, the first row's ``cols`` and the arg-min / arg-max rows'
    ``order`` and ``cols``; output ``rows``.  ``every``: only each
    ``every``-th row of a key (W8, never purged).

    Rows of a batch count in ``order`` (a total order per key, not null),
    batches in the order they come; the first of equal extremes wins.  Null
    keys are a key; a null ``value`` adds nothing but counts as a row."""
    keys, cols = _keys(keys), _keys(cols)

    def step(batch: DataFrame, carried, batch_id: int) -> tuple[Tables, Tables]:
        v, o, b = F.col(value), _order_number(batch, order), F.lit(batch_id).cast("bigint")
        payload = F.struct(F.col(order).alias("_o"), *[F.col(c) for c in cols])
        rows = batch.select(*dict.fromkeys([*keys, order, value, *cols])).withColumns({
            "_n": F.lit(1).cast("bigint"), "_s": _summed(batch, value), "_mn": v, "_mx": v,
            "_f": F.struct(b.alias("b"), o.alias("o"), payload.alias("p")),
            "_lo": F.when(v.isNotNull(), F.struct(v.alias("v"), b.alias("b"), o.alias("o"), payload.alias("p"))),
            "_hi": F.when(v.isNotNull(), F.struct(v.alias("v"), (-b).alias("b"), (-o).alias("o"), payload.alias("p")))})
        how = {"_n": "sum", "_s": "sum", "_mn": "min", "_mx": "max", "_f": "min", "_lo": "min", "_hi": "max"}
        whole = _front(carried("totals"), rows, order)
        out = running(whole, keys, order, {f"_fl{c}": (kind, F.col(c)) for c, kind in how.items()}).filter("not _fl_seed")
        if every:
            out = out.filter(F.col("_fl_n") % every == 0)
        fields = [F.col("_fl_n").alias("n"), F.col("_fl_s").alias("sum"), F.col("_fl_mn").alias("min"), F.col("_fl_mx").alias("max")]
        fields += [F.col(f"_fl_f.p.{c}").alias(f"first_{c}") for c in cols]
        for name, c in (("argmin", "_fl_lo"), ("argmax", "_fl_hi")):
            fields += [F.col(f"{c}.p._o").alias(f"{name}_{order}"), *[F.col(f"{c}.p.{x}").alias(f"{name}_{x}") for x in cols]]
        total = {"sum": F.sum, "min": F.min, "max": F.max}
        state = whole.groupBy(*keys).agg(*[total[kind](c).alias(c) for c, kind in how.items()])
        return {"rows": out.select(*keys, order, value, *fields)}, {"totals": state}
    return step


def window_carry(keys, order: str, value: str, size: int, with_values: bool = False) -> Step:
    """K1-K4 (and S10 as one row per flush) on a stream: each ``size`` rows of
    a key give ``window_no, rows, total``, the first and last ``order`` and
    with ``with_values`` the values as text; output ``windows``.  What a key
    carries is its count and its open window; an open window is not emitted."""
    keys = _keys(keys)

    def step(batch: DataFrame, carried, batch_id: int) -> tuple[Tables, Tables]:
        before = carried("windows")
        rows = batch.select(*dict.fromkeys([*keys, order, value])).withColumn("_n", F.lit(1).cast("bigint"))
        seeds = None if before is None else before.select(*keys, (F.col("w") * size + F.col("rows")).alias("_n"))
        placed = running(_front(seeds, rows, order), keys, order, {"_pos": ("sum", F.col("_n"))}).filter("not _fl_seed")
        at = F.struct(F.col("_pos").alias("p"), F.col(order).alias("o"))
        parts = placed.withColumn("w", F.floor((F.col("_pos") - 1) / size).cast("bigint")).groupBy(*keys, "w").agg(
            F.count(F.lit(1)).alias("rows"), F.sum(_summed(placed, value)).alias("total"), F.min(at).alias("first"), F.max(at).alias("last"),
            *([F.collect_list(F.struct(F.col("_pos").alias("p"), F.col(value).alias("v"))).alias("values")] if with_values else []))
        if before is not None:
            parts = parts.unionByName(before)
        merged = parts.groupBy(*keys, "w").agg(
            F.sum("rows").alias("rows"), F.sum("total").alias("total"), F.min("first").alias("first"), F.max("last").alias("last"),
            *([F.flatten(F.collect_list("values")).alias("values")] if with_values else []))
        merged = carried.once(merged)
        out = merged.filter(F.col("rows") == size).select(
            *keys, F.col("w").alias("window_no"), "rows", "total", F.col("first.o").alias(f"first_{order}"), F.col("last.o").alias(f"last_{order}"),
            *([_as_text("values").alias("values")] if with_values else []))
        fields = [c for c in merged.columns if c not in keys]
        latest = merged.groupBy(*keys).agg(F.max_by(F.struct(*fields), "w").alias("l")).select(*keys, "l.*")
        full = F.col("rows") == size
        state = latest.select(
            *keys, F.when(full, F.col("w") + 1).otherwise(F.col("w")).alias("w"), F.when(full, 0).otherwise(F.col("rows")).cast("bigint").alias("rows"),
            *[F.when(~full, F.col(c)).alias(c) for c in fields if c in ("total", "first", "last")],
            *([F.when(full, F.slice("values", 1, 0)).otherwise(F.col("values")).alias("values")] if with_values else []))
        return {"windows": out}, {"windows": state}
    return step


def sink_carry(shard, order: str, threshold: int) -> Step:
    """S10 / K9 on a stream: rows are held per shard and flushed when
    ``threshold`` of them are there; output ``flushed``: the rows themselves
    with ``batch_no``.  The rest, fewer than ``threshold`` rows a shard, is
    carried as rows, over restarts too."""
    shard = _keys(shard)

    def step(batch: DataFrame, carried, batch_id: int) -> tuple[Tables, Tables]:
        counts, held = carried("counts"), carried("held")
        rows = batch.withColumn("_n", F.lit(1).cast("bigint"))
        whole = _front(counts, rows, order)
        placed = running(whole, shard, order, {"_pos": ("sum", F.col("_n"))}).filter("not _fl_seed").drop("_n", "_fl_seed")
        if held is not None:
            placed = placed.unionByName(held)
        placed = placed.withColumn("batch_no", F.floor((F.col("_pos") - 1) / threshold).cast("bigint"))
        full = F.count(F.lit(1)).over(W.partitionBy(*shard, "batch_no")) == threshold   # at most threshold rows
        placed = carried.once(placed.withColumn("_full", full))
        return ({"flushed": placed.filter("_full").drop("_full", "_pos")},
                {"held": placed.filter("not _full").drop("_full", "batch_no"), "counts": whole.groupBy(*shard).agg(F.sum("_n").alias("_n"))})
    return step


def session_carry(time_col: str, gap_us: int, aggs: dict[str, tuple[str, Column]], keys=None, delay_us: int = 0,
                  late: str = "row") -> Step:
    """W5-W7 on a stream, keyed or global: closed sessions (``sessions``) and
    what was late (``late``).

    A batch's rows are collapsed into gap-wide buckets, and the buckets meet
    the open sessions only; a global session is no constant key.  The
    watermark is the greatest time of all batches less ``delay_us``; a session
    closes when its end is not behind it.  ``late="row"``: a row whose own
    ``[t, t + gap)`` ends at or before the watermark of the batch before is
    late.  ``late="merged"``: rows are merged into open sessions first, and
    only a session without an open one that ends there is late.  Late rows
    (or sessions) go to ``late`` and nowhere else.  Rows without a time belong
    to no session and are left out.  Open sessions stay in the state;
    ``open_sessions`` gives them for a flush."""
    keys = _keys(keys)
    if late not in ("row", "merged"):
        raise ValueError(f"late must be 'row' or 'merged', not {late!r}")
    combine = {n: _COMBINE[kind](F.col(n)).alias(n) for n, (kind, _) in aggs.items()}

    def step(batch: DataFrame, carried, batch_id: int) -> tuple[Tables, Tables]:
        clock, opened = carried("clock"), carried("open")
        rows = batch.withColumn("_fl_t", F.unix_micros(F.col(time_col).cast("timestamp"))).filter("_fl_t is not null")
        seen = None if clock is None else clock.first()["max_t"]
        top = max((t for t in (seen, rows.agg(F.max("_fl_t")).first()[0]) if t is not None), default=None)
        then = None if seen is None else seen - delay_us
        is_late = F.lit(False) if then is None else F.col("_fl_t") + gap_us <= then
        fresh = rows.filter(~is_late) if late == "row" else rows
        out: Tables = {"late": rows.filter(is_late).drop("_fl_t")} if late == "row" else {}
        parts = fresh.groupBy(*keys, F.floor(F.col("_fl_t") / gap_us).alias("_fl_b")).agg(
            F.min("_fl_t").alias("_fl_s"), F.max("_fl_t").alias("_fl_e"), *_agg_exprs(aggs)).drop("_fl_b").withColumn("_fl_old", F.lit(False))
        if opened is not None:
            parts = parts.unionByName(opened.withColumn("_fl_old", F.lit(True)))
        merged = carried.once(merge_intervals(parts, keys, gap_us, {**combine, "_fl_old": F.max("_fl_old").alias("_fl_old")}, carried.once))
        end = F.col("_fl_e") + gap_us
        if late == "merged" and then is not None:
            gone = (end <= then) & ~F.col("_fl_old")
            out["late"] = session_rows(merged.filter(gone), keys, gap_us, aggs, batch, time_col)
            merged = merged.filter(~gone)
        closed = F.lit(False) if top is None else end <= top - delay_us
        out["sessions"] = session_rows(merged.filter(closed), keys, gap_us, aggs, batch, time_col)
        state = {"open": merged.filter(~closed).drop("_fl_old"),
                 "clock": batch.sparkSession.range(1).select(F.lit(top).cast("bigint").alias("max_t"))}
        return out, state
    return step


def session_rows(merged: DataFrame, keys, gap_us: int, aggs, like: DataFrame, time_col: str) -> DataFrame:
    """Merged intervals as ``session_start, session_end`` in the type of ``time_col``."""
    kind = dict(like.dtypes)[time_col]
    start, end = F.timestamp_micros("_fl_s").cast(kind), F.timestamp_micros(F.col("_fl_e") + gap_us).cast(kind)
    return merged.select(*_keys(keys), start.alias("session_start"), end.alias("session_end"), *aggs)


def sessions_to_end(run: CarryRun, stream: DataFrame, time_col: str, gap_us: int, aggs, keys=None, delay_us: int = 0,
                    late: str = "row", conf: dict | None = None) -> DataFrame:
    """All sessions of a bounded input read as a stream: those closed on the
    way and, flushed exactly once at the end, those still open."""
    run.run(stream, session_carry(time_col, gap_us, aggs, keys, delay_us, late), conf)
    opened = run.carried("open")
    if opened is not None:
        run.flush("sessions", session_rows(opened, keys, gap_us, aggs, stream, time_col), "open")
    when = stream.schema[time_col].dataType
    fields = [StructField("session_start", when), StructField("session_end", when), *[StructField(n, LongType()) for n in aggs]]
    return run.result("sessions", StructType([*[stream.schema[k] for k in _keys(keys)], *fields]))
