"""Stream readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """A topic from its beginning (needs Spark's Kafka package).

    ``value`` stays bytes; ``partition`` and ``offset`` go along for the dead
    letters. Offsets are kept in the checkpoint of the query that reads.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
        .select("key", "value", "topic", "partition", "offset", F.col("timestamp").alias("received_at"))
    )


def read_message_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Keyed JSON lines as written by ``write_messages``; new files become new batches."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    line = F.from_json("value", "key string, value string").alias("m")
    return reader.text(path).select(
        line, F.col("_metadata.file_modification_time").alias("received_at"), F.col("_metadata.file_name").alias("file")
    ).select("m.key", "m.value", "received_at", "file")


def read_parquet_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Parquet files of a folder or glob as a stream, with the schema of the files already there."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def stream_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table read as a stream; the glob covers a single file as well as a folder."""
    return read_parquet_stream(spark, f"{root}/{name}.parquet*")


def deduplicated(events: DataFrame, key: list[str], ts: str, delay: str) -> DataFrame:
    """Drops repeats of a key that come within ``delay`` of event time.

    State is bounded by the delay. The time column must be a ``timestamp``.
    """
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(key)
