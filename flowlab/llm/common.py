"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlab.session import scratch_path

PACKAGE_DIR = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

BATCH_ROWS, MAX_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that the
    Arrow functions import it wherever the driver was started."""
    if int(spark.conf.get(BATCH_ROWS)) > MAX_BATCH_ROWS:
        spark.conf.set(BATCH_ROWS, str(MAX_BATCH_ROWS))  # rows are whole documents
    sc = spark.sparkContext
    if getattr(sc, "_flowlab_shipped", False):
        return
    out = os.path.join(tempfile.mkdtemp(prefix="flowlab-zip-"), "flowlab_pkg")
    root, name = os.path.split(PACKAGE_DIR)
    sc.addPyFile(shutil.make_archive(out, "zip", root_dir=root, base_dir=name))
    sc._flowlab_shipped = True


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` below the shared checkpoint folder and
    read it back.  Survives lost executors.  The shuffle files of the write
    go at its end, not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    was = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.set(CLEANUP, was)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete written tables that are read no more."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for df in tables:
        for file in df.inputFiles()[:1]:
            folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(conf).delete(folder, True)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` over single batches: memory is bounded by one batch."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch)
            if out is not None and out.num_rows:
                yield out
    return df.mapInArrow(run, schema)


def strings(batch: pa.RecordBatch, name: str) -> list[str]:
    """A text column as Python strings; null is the empty text."""
    return [v or "" for v in batch.column(name).to_pylist()]


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
