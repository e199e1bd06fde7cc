"""The driver's parquet tables, as batch DataFrames or as file streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Batch scan; projections and filters written later reach the scan."""
    return spark.read.parquet(table_path(sf_dir, name))


def table_stream(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Replay a table as a file stream.

    A single file is not a valid stream source path, so the directory is
    streamed with a glob filter that selects the one table.  The schema is
    taken from the parquet footer (no inference pass over the data).
    """
    schema = spark.read.parquet(table_path(sf_dir, name)).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(sf_dir)


def directory_stream(spark: SparkSession, path: str, schema,
                     max_files_per_trigger: int | None = 1000) -> DataFrame:
    """Replay a directory of parquet files (e.g. a landing folder) as a
    stream; ``max_files_per_trigger`` bounds each micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def state_partitions(spark: SparkSession, sf_dir: str, name: str, bytes_per_partition: int = 64 << 20) -> int:
    """State-store partitions for a stream replaying a table: one per
    ``bytes_per_partition`` of input, at least the cluster's parallelism and
    at most the session's ``spark.sql.shuffle.partitions``.  (The count is
    fixed when a stream's checkpoint is created.)"""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, name))
    size = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
    cap = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    floor = spark.sparkContext.defaultParallelism
    return max(1, min(cap, max(floor, -(-int(size) // bytes_per_partition))))
