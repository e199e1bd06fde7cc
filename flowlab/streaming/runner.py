"""Run a streaming DataFrame to completion and read its result back.

Sinks and checkpoints live below the shared checkpoint directory
(``flowlab.session.scratch_path``), so a restarted driver or a lost executor
resumes from the last committed micro-batch.

* ``append``: parquet file sink, exactly-once through its ``_spark_metadata``
  commit log; the batch reader only sees committed files.
* ``update`` / ``complete``: ``foreachBatch`` writes each micro-batch to its
  own ``batch=<id>`` directory with overwrite, so replaying a batch after a
  failure rewrites the same files (idempotent on the batch id).  Reading
  back keeps the latest version of every key.
"""

from __future__ import annotations

import contextlib
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowlab.session import ROCKSDB_PROVIDER, scratch_path

# State lives in RocksDB (spills to local disk, state larger than memory);
# each micro-batch commits a change log instead of uploading a snapshot.
STATEFUL_CONF = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
                 "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}
# The reference drops a late row against the watermark of the previous
# batch; Spark does so only with this setting (measured, see README).
LATE_PARITY_CONF = {"spark.sql.streaming.statefulOperator.allowMultiple": "false"}
# Merge sessions inside each partition before the shuffle (streaming
# counterpart of the batch pre-collapse).
SESSION_CONF = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}


@contextlib.contextmanager
def scoped_conf(spark: SparkSession, conf: dict | None):
    """Set session confs for the duration of a query start, then restore."""
    old = {}
    for k, v in (conf or {}).items():
        try:
            old[k] = spark.conf.get(k)
        except Exception:  # noqa: BLE001 - unset key
            old[k] = None
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def versioned_writer(out: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    return write


def start_stream(df: DataFrame, out: str, checkpoint: str, output_mode: str = "append",
                 trigger: dict | None = None, query_name: str | None = None):
    trigger = trigger or {"availableNow": True}
    if output_mode == "append":
        w = df.writeStream.format("parquet").option("path", out)
    else:
        w = df.writeStream.foreachBatch(versioned_writer(out))
    w = w.outputMode(output_mode).option("checkpointLocation", checkpoint).trigger(**trigger)
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def read_back(spark: SparkSession, out: str, schema, output_mode: str = "append",
              keys: list[str] | None = None) -> DataFrame:
    if not path_exists(spark, out):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).parquet(out) if output_mode == "append" else spark.read.parquet(out)
    if output_mode == "append":
        return df
    if not keys:
        # complete mode without key: the last batch holds the whole result
        last = df.agg(F.max("batch")).first()[0]
        return df.filter(F.col("batch") == last).drop("batch")
    w = Window.partitionBy(*keys).orderBy(F.col("batch").desc())
    return df.withColumn("_fl_rn", F.row_number().over(w)).filter("_fl_rn = 1").drop("_fl_rn", "batch")


class StreamRun:
    """Locations of one streaming run (sink + checkpoint)."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.out = scratch_path(spark, f"{name}-out")
        self.checkpoint = scratch_path(spark, f"{name}-checkpoint")
        self.last_progress = None

    def run(self, df: DataFrame, output_mode: str = "append", conf: dict | None = None,
            trigger: dict | None = None, timeout_s: float | None = None):
        with scoped_conf(self.spark, {**STATEFUL_CONF, **(conf or {})}):
            q = start_stream(df, self.out, self.checkpoint, output_mode, trigger)
            q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
        self.last_progress = q.recentProgress
        return q

    def result(self, schema, output_mode: str = "append", keys=None) -> DataFrame:
        return read_back(self.spark, self.out, schema, output_mode, keys)


def run_to_completion(spark: SparkSession, df: DataFrame, name: str, output_mode: str = "append",
                      keys: list[str] | None = None, conf: dict | None = None) -> DataFrame:
    """Process everything available (``availableNow``) and return the sink's
    content as a batch DataFrame."""
    run = StreamRun(spark, name)
    if output_mode != "append":
        # update / complete: the sink holds the final values after the last
        # data batch; a trailing no-data batch would only evict state
        conf = {"spark.sql.streaming.noDataMicroBatches.enabled": "false", **(conf or {})}
    run.run(df, output_mode, conf)
    return run.result(df.schema, output_mode, keys)


def run_with_restarts(start: Callable[[], object], attempts: int = 3, delay_s: float = 0.1):
    """K7: start a query and wait for it; on failure start it again (same
    checkpoint, so it resumes) up to ``attempts`` more times, ``delay_s``
    apart.  ``start`` must return a started ``StreamingQuery``."""
    failures = 0
    while True:
        q = start()
        try:
            q.awaitTermination()
            return q
        except Exception:  # noqa: BLE001 - StreamingQueryException and friends
            failures += 1
            if failures > attempts:
                raise
            time.sleep(delay_s)
