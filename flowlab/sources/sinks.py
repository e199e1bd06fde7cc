"""Sinks: delimited text (S5), tuple text (S6/S7), file streams (S8),
console (S9).  The threshold-batched sink (S10) lives in
``flowlab.operators.counting`` (batch) and ``flowlab.streaming.stateful``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.functions.exprs import joined_text, tuple_text


def write_delimited(df: DataFrame, path: str, sep: str = " ", mode: str = "errorifexists") -> None:
    """One line per row, fields joined by ``sep`` with no quoting (byte parity
    with a plain delimited writer; Spark's csv writer would quote)."""
    df.select(joined_text(sep, *df.columns).alias("value")) \
        .write.mode(mode).text(path)


def write_tuples(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Rows rendered as ``(a,b,c)``; ``mode`` is ``overwrite`` (S6) or the
    default fail-if-present (S7)."""
    df.select(tuple_text(*df.columns).alias("value")).write.mode(mode).text(path)


def stream_to_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                    output_mode: str = "append", trigger: dict | None = None,
                    max_records_per_file: int | None = None, query_name: str | None = None):
    """Rolling file sink: exactly-once through the sink's commit log.

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (e.g.
    ``{"processingTime": "1 second"}``, ``{"availableNow": True}``).
    Text output renders rows as tuples.
    """
    if fmt == "text":
        df = df.select(tuple_text(*df.columns).alias("value"))
    w = df.writeStream.format(fmt).outputMode(output_mode) \
        .option("path", path).option("checkpointLocation", checkpoint)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


def stream_to_console(df: DataFrame, output_mode: str = "update", checkpoint: str | None = None):
    w = df.writeStream.format("console").outputMode(output_mode).option("truncate", False)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.start()
