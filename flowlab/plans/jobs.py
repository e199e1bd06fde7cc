"""The reference's programs as parameterised jobs over line files.

Each job takes its inputs as keyword arguments, returns the result as a
DataFrame (or a dict of them) and writes it only when ``output`` is given,
in the reference's text format.  Arrival order is the line order (``seq``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.functions.exprs import millis_to_time
from flowlab.functions.parse import parse_fields
from flowlab.operators import (count_trigger, count_window, count_window_list, equi_join, exclude,
                               final_aggregates, group_sum, iterate, pair_one, parity_split, prefix_filter,
                               rolling_count, rolling_max, rolling_max_by, rolling_min, rolling_min_by,
                               rolling_sum, sessions, sliding, tumbling)
from flowlab.operators.prefix import running
from flowlab.sources.sinks import stream_to_files, write_delimited, write_tuples
from flowlab.sources.text import line_stream, read_lines, sequence
from flowlab.streaming.operators import (count_trigger_stream, count_window_stream, exclude_stream,
                                         processing_time, rolling_stream, session_agg_stream,
                                         window_agg_stream, with_event_time)
from flowlab.streaming.runner import STATEFUL_CONF, scoped_conf, versioned_writer

# Fixed values of the reference's programs; results equal the reference's only with these.
WORD_PREFIX = "N"                       # word count keeps lines starting with this
OUTPUT_SEP = " "                        # field separator of the delimited sink
MISSING_FILL = "NULL"                   # text written for the missing side of an outer join
COUNT_TRIGGER_EVERY = 5                 # global window fires on every 5th row of a key
COUNT_WINDOW_SIZE = 10                  # keyed state sums every 10 values
TUMBLING = "2 seconds"                  # sales windows on processing time
SLIDING, SLIDE = "2 seconds", "1 second"
SALES_SESSION_GAP = "1 second"
READING_SLIDING, READING_SLIDE = "4 seconds", "2 seconds"   # readings windows on event time
READING_SESSION_GAP = "1 second"
LATE_SESSION_GAP, LATE_DELAY = "10 seconds", "3500 milliseconds"   # bounded-lateness watermark job
ITERATE_FROM, ITERATE_TO, ITERATE_TARGET = 0, 5, 10


def _micros(interval: str) -> int:
    """``"<n> seconds" / "<n> second" / "<n> milliseconds"`` in microseconds."""
    n, unit = interval.split()
    scale = {"second": 1_000_000, "seconds": 1_000_000, "millisecond": 1_000, "milliseconds": 1_000}[unit]
    return int(n) * scale


def word_count(spark: SparkSession, input: str, output: str | None = None, prefix: str = WORD_PREFIX) -> DataFrame:
    """Lines starting with ``prefix`` (one line = one word), counted."""
    words = prefix_filter(read_lines(spark, input, with_seq=False), "value", prefix)
    counts = group_sum(pair_one(words, "value"), "value", "one", name="n").withColumnRenamed("value", "word")
    if output:
        write_delimited(counts, output, sep=OUTPUT_SEP)
    return counts


def join_people(spark: SparkSession, input1: str, input2: str, how: str = "inner",
                output: str | None = None) -> DataFrame:
    """``(id, name, state)`` for the person and location files; outer joins
    fill the missing side with the string ``NULL``."""
    person = parse_fields(read_lines(spark, input1, with_seq=False), "person")
    location = parse_fields(read_lines(spark, input2, with_seq=False), "location")
    out = equi_join(person, location, "id", how, fill=MISSING_FILL)
    if output:
        write_delimited(out, output, sep=OUTPUT_SEP)
    return out


def sales(spark: SparkSession, input: str) -> DataFrame:
    """``seq, month, category, product, profit`` (the date is dropped)."""
    return parse_fields(read_lines(spark, input), "sale", keep=["seq"]).drop("date")


def rolling_sales(spark: SparkSession, input: str, output: str | None = None) -> dict[str, DataFrame]:
    """Rolling sum / min / minBy / max / maxBy of profit per month, one row
    per input row, as ``month, category, product, profit``."""
    s = sales(spark, input)
    carry = ["category", "product"]

    def firsts(df, agg):
        return df.select("seq", "month", F.col("first_category").alias("category"),
                         F.col("first_product").alias("product"), F.col(agg).alias("profit"))

    def args(df, p):
        return df.select("seq", "month", F.col(f"{p}_category").alias("category"),
                         F.col(f"{p}_product").alias("product"), F.col(f"{p}_profit").alias("profit"))

    out = {
        "sum": firsts(rolling_sum(s, "month", "seq", "profit", carry, name="agg"), "agg"),
        "min": firsts(rolling_min(s, "month", "seq", "profit", carry, name="agg"), "agg"),
        "minBy": args(rolling_min_by(s, "month", "seq", "profit", carry), "argmin"),
        "max": firsts(rolling_max(s, "month", "seq", "profit", carry, name="agg"), "agg"),
        "maxBy": args(rolling_max_by(s, "month", "seq", "profit", carry), "argmax"),
    }
    if output:
        for name, df in out.items():
            write_tuples(df.drop("seq"), f"{output}/{name}", mode="overwrite")
    return out


def average_profit(spark: SparkSession, input: str, output: str | None = None) -> DataFrame:
    """Per row: ``month, profit so far / rows so far`` (R7 then R8)."""
    s = sales(spark, input).withColumn("one", F.lit(1))
    r = running(s, "month", "seq", {"p": ("sum", F.col("profit")), "n": ("sum", F.col("one"))})
    out = r.select("seq", "month", (F.col("p").cast("double") / F.col("n")).alias("avg_profit"))
    if output:
        write_tuples(out.drop("seq"), output)
    return out


def final_sales(spark: SparkSession, input: str) -> DataFrame:
    """What the rolling jobs end at, per month."""
    return final_aggregates(sales(spark, input), "month", "seq", "profit", cols=["category", "product"])


def count_trigger_sales(spark: SparkSession, input: str, every: int = COUNT_TRIGGER_EVERY) -> DataFrame:
    """Global window per month firing every ``every`` rows with running totals
    (profit, row count) and the month's first category/product."""
    s = sales(spark, input)
    return count_trigger(s, "month", "seq", "profit", every=every, carry=["category", "product"])


def split_numbers(spark: SparkSession, input: str, output: str | None = None) -> dict[str, DataFrame]:
    nums = parse_fields(read_lines(spark, input, with_seq=False), "number")
    parts = parity_split(nums, "n")
    if output:
        write_tuples(parts["even"], f"{output}/even")
        write_tuples(parts["odd"], f"{output}/odd")
    return parts


def iterate_to_ten(spark: SparkSession, start: int = ITERATE_FROM, end: int = ITERATE_TO,
                   max_iter: int = 100) -> DataFrame:
    """``(n, 0)`` for ``n`` in ``start..end``; add 1 to both until ``n = 10``."""
    seed = sequence(spark, start, end).select(F.col("n").cast("bigint"), F.lit(0).cast("bigint").alias("m"))

    def step(df):
        done = F.col("n") == ITERATE_TARGET
        return df.select(F.when(done, F.col("n")).otherwise(F.col("n") + 1).alias("n"),
                         F.when(done, F.col("m")).otherwise(F.col("m") + 1).alias("m"))

    return iterate(seed, step, lambda: F.col("n") == ITERATE_TARGET, max_iter=max_iter)


def department_counts(spark: SparkSession, input: str, excluded: str) -> DataFrame:
    """Employees whose id is not in the excluded file, with the running count
    of kept employees per department: ``dept, n``."""
    emp = parse_fields(read_lines(spark, input), "employee", keep=["seq"])
    exc = parse_fields(read_lines(spark, excluded, with_seq=False), "employee")
    kept = exclude(emp, exc, "id")
    return rolling_count(kept, "dept", "seq", name="n").select("seq", "dept", "n")


def readings(spark: SparkSession, input: str) -> DataFrame:
    """``seq, ts_ms, value, ts`` from ``<epoch ms>,<value>`` lines."""
    r = parse_fields(read_lines(spark, input), "reading", keep=["seq"])
    return r.withColumn("ts", millis_to_time("ts_ms"))


def reading_windows(spark: SparkSession, input: str, kind: str = "sliding") -> DataFrame:
    """Un-keyed windows over readings, summing ``value``: ``sliding`` 4 s / 2 s,
    ``session`` gap 1 s, ``session10`` gap 10 s."""
    r = readings(spark, input)
    aggs = {"total": ("sum", F.col("value"))}
    if kind == "sliding":
        return sliding(r, "ts", READING_SLIDING, READING_SLIDE, aggs)
    if kind == "tumbling":
        return tumbling(r, "ts", TUMBLING, aggs)
    gap = READING_SESSION_GAP if kind == "session" else LATE_SESSION_GAP
    return sessions(r, "ts", _micros(gap), aggs)


def keyed_count_windows(spark: SparkSession, input: str, size: int = COUNT_WINDOW_SIZE,
                        with_values: bool = False) -> DataFrame:
    """``key,value`` lines: sum of every ``size`` values per key."""
    kn = parse_fields(read_lines(spark, input), "keyed_number", keep=["seq"])
    if with_values:
        return count_window_list(kn, "key", "seq", "value", size=size)
    return count_window(kn, "key", "seq", "value", size=size)


# ---------------------------------------------------------------- streaming jobs
# Each returns an unstarted streaming DataFrame over a directory of line
# files (file replay; ``max_files_per_trigger`` sets the micro-batch).  Start
# it with ``run_stream_job`` or any ``writeStream``.  A text stream has no
# line number, so order-dependent jobs use the order in which rows are
# delivered inside a micro-batch (and the batch order across batches).



def run_stream_job(df: DataFrame, output: str, checkpoint: str, output_mode: str = "append",
                   fmt: str = "text", trigger: dict | None = None, stateful: bool = False):
    """Start a job's stream into a checkpointed file sink (S8); returns the
    running query.  ``trigger={"processingTime": "1 second"}`` gives the
    periodic checkpoints of a long-running job (K6)."""
    with scoped_conf(df.sparkSession, STATEFUL_CONF if stateful else None):
        if output_mode == "append":
            return stream_to_files(df, output, checkpoint, fmt=fmt, trigger=trigger)
        w = df.writeStream.foreachBatch(versioned_writer(output)).outputMode(output_mode) \
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True}))
        return w.start()


def word_count_stream(spark: SparkSession, input_dir: str, prefix: str = WORD_PREFIX) -> DataFrame:
    """Running count per word (update mode: one row per word per batch)."""
    words = prefix_filter(line_stream(spark, input_dir), "value", prefix)
    return words.groupBy(F.col("value").alias("word")).agg(F.count(F.lit(1)).alias("n"))


def sales_stream(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    lines = line_stream(spark, input_dir, max_files_per_trigger=max_files_per_trigger)
    return parse_fields(lines, "sale").drop("date")


def rolling_sales_stream(spark: SparkSession, input_dir: str, **kw) -> DataFrame:
    """R2-R7 per month, one row per input row: running n, sum, min, max of
    profit, the first row's and the extreme rows' category and product."""
    return rolling_stream(sales_stream(spark, input_dir, **kw), "month", None, "profit",
                          ["category", "product"], emit="row")


def average_profit_stream(spark: SparkSession, input_dir: str, **kw) -> DataFrame:
    """Running average profit per month."""
    r = rolling_sales_stream(spark, input_dir, **kw)
    return r.select("month", (F.col("sum").cast("double") / F.col("n")).alias("avg_profit"))


def sales_window_stream(spark: SparkSession, input_dir: str, kind: str = "tumbling", **kw) -> DataFrame:
    """W1 / W3 / W5 on processing time, keyed by month: total profit and
    rows per window (tumbling 2 s, sliding 2 s / 1 s, session gap 1 s).
    Sessions run in append or complete mode only."""
    s = processing_time(sales_stream(spark, input_dir, **kw), "t")
    aggs = {"profit": F.sum("profit"), "n": F.count(F.lit(1))}
    if kind == "tumbling":
        return window_agg_stream(s, "t", TUMBLING, None, aggs, keys=["month"])
    if kind == "sliding":
        return window_agg_stream(s, "t", SLIDING, SLIDE, aggs, keys=["month"])
    if kind == "session":
        return session_agg_stream(s.withWatermark("t", "0 seconds"), "t", SALES_SESSION_GAP, aggs, keys=["month"])
    raise ValueError(kind)


def sales_count_trigger_stream(spark: SparkSession, input_dir: str, every: int = COUNT_TRIGGER_EVERY,
                               **kw) -> DataFrame:
    """Cumulative profit at every ``every``-th row of a month."""
    s = sales_stream(spark, input_dir, **kw)
    return count_trigger_stream(s, "month", None, "profit", every, "category")


def readings_window_stream(spark: SparkSession, input_dir: str, kind: str = "sliding", **kw) -> DataFrame:
    """Un-keyed event-time windows over ``<epoch ms>,<value>`` lines:
    ``sliding`` 4 s / 2 s with a monotone watermark (W4), ``session`` gap 1 s
    (W6), ``watermark`` session gap 10 s with 3.5 s allowed lateness (W7)."""
    r = parse_fields(line_stream(spark, input_dir, **kw), "reading")
    delay = LATE_DELAY if kind == "watermark" else "0 seconds"
    r = with_event_time(r, "ts_ms", "et", delay, millis=True)
    aggs = {"total": F.sum("value")}
    if kind == "sliding":
        return window_agg_stream(r, "et", READING_SLIDING, READING_SLIDE, aggs)
    if kind == "session":
        return session_agg_stream(r, "et", READING_SESSION_GAP, aggs)
    if kind == "watermark":
        return session_agg_stream(r, "et", LATE_SESSION_GAP, aggs)
    raise ValueError(kind)


def keyed_sum_stream(spark: SparkSession, input_dir: str, size: int = COUNT_WINDOW_SIZE, with_values: bool = False,
                     **kw) -> DataFrame:
    """K1-K4: ``key,value`` lines; the sum of every ``size`` values of a key
    (with the values as text for K2)."""
    kn = parse_fields(line_stream(spark, input_dir, **kw), "keyed_number")
    return count_window_stream(kn, "key", None, "value", size, with_values)


def department_count_stream(spark: SparkSession, input_dir: str, excluded: str, **kw) -> DataFrame:
    """J5 + R1: employees not in the excluded file, with the running count of
    kept employees per department (one row per kept employee)."""
    emp = parse_fields(line_stream(spark, input_dir, **kw), "employee").withColumn("one", F.lit(1))
    exc = parse_fields(read_lines(spark, excluded, with_seq=False), "employee")
    kept = exclude_stream(emp, exc, "id")
    return rolling_stream(kept, "dept", None, "one", ["id"]).select("dept", F.col("n"))


def split_numbers_stream(spark: SparkSession, input_dir: str, output: str, checkpoint: str, **kw):
    """P11 on a stream: one ``foreachBatch`` writes both typed branches of
    every micro-batch (overwriting ``<branch>/batch=<id>``: idempotent)."""
    nums = parse_fields(line_stream(spark, input_dir, **kw), "number")

    def write(batch: DataFrame, batch_id: int) -> None:
        parts = parity_split(batch, "n")
        for name in ("even", "odd"):
            parts[name].write.mode("overwrite").parquet(f"{output}/{name}/batch={batch_id}")

    return nums.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint) \
        .trigger(availableNow=True).start()
