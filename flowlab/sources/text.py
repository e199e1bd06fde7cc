"""Line sources: bounded text scan (S1), text stream (S2/S3), sequence."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str, with_seq: bool = True) -> DataFrame:
    """``value string`` per line, plus ``seq``: an arrival order.

    ``monotonically_increasing_id`` grows with (file split, position), so it
    is a total order that follows the file without a shuffle or a single
    task; it is not dense, which no operator needs.
    """
    df = spark.read.text(path)
    return df.withColumn("seq", F.monotonically_increasing_id()) if with_seq else df


DEFAULT_FILES_PER_TRIGGER = 1000


def line_stream(spark: SparkSession, path: str | None = None, format: str = "text",
                max_files_per_trigger: int | None = DEFAULT_FILES_PER_TRIGGER, **options) -> DataFrame:
    """Unbounded line source.

    ``format="text"`` (default) replays a directory of files, which is
    replayable and therefore recoverable; ``format="socket"`` takes
    ``host``/``port`` options and is not replayable (kept for parity, never
    used in tests).  ``max_files_per_trigger`` bounds each micro-batch, and
    with it the rows a keyed state step holds at once.
    """
    reader = spark.readStream.format(format)
    if max_files_per_trigger and format != "socket":
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path) if path is not None else reader.load()


def sequence(spark: SparkSession, start: int, end: int) -> DataFrame:
    """Integers ``start..end``, both ends inclusive, as column ``n``."""
    return spark.range(start, end + 1).withColumnRenamed("id", "n")
