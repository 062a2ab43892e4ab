"""Streaming sources.

Kafka needs the spark-sql-kafka connector on the classpath (absent offline,
so untested here); file sources exercise the same downstream code in tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_lines(spark: SparkSession, bootstrap_servers: str, topic: str,
                starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Kafka topic as a stream of text lines (column ``value`` string)."""
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap_servers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load().select(F.col("value").cast("string").alias("value"))


def text_lines_stream(spark: SparkSession, directory: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Each new text file's lines as ``value`` rows (a file stand-in for Kafka)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(directory)


def parquet_table_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A parquet table as a stream.  A single-file table is streamed from its
    directory with a glob filter (a file path cannot be a stream source)."""
    schema = spark.read.parquet(path).schema
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getFileStatus(where).isFile():
        d, _, name = path.rpartition("/")
        return r.option("pathGlobFilter", name).parquet(d)
    return r.parquet(path)
