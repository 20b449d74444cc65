"""Batch writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Partition layout and rows per file of each lake table.
RAW_EVENTS_LAYOUT = ["year", "month", "day", "hour"]
FEATURE_UPDATES_LAYOUT = ["entity_type", "year", "month", "day"]
RAW_EVENTS_ROWS_PER_FILE = 100_000
FEATURE_UPDATES_ROWS_PER_FILE = 50_000


def write_features(features: DataFrame, path: str, replace_dates_only: bool = False) -> None:
    """Wide feature table, one folder per ``event_date``, sorted by user in each file.

    The rebalance brings the rows of a date together without giving a large
    date to one task: partitions beyond the advisory size are split. The sort
    lets a lookup of one user skip most row groups. ``replace_dates_only``
    overwrites the dates present in ``features`` and leaves the others.
    """
    mode = "dynamic" if replace_dates_only else "static"
    (
        features.hint("rebalance", "event_date")
        .sortWithinPartitions("event_date", "user_id")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy("event_date")
        .parquet(path)
    )


def with_time_parts(rows: DataFrame, ts: str, hour: bool = True) -> DataFrame:
    """Adds the folder columns ``year, month, day`` and ``hour`` as padded text."""
    parts = {"year": "yyyy", "month": "MM", "day": "dd"}
    if hour:
        parts["hour"] = "HH"
    return rows.select("*", *[F.date_format(ts, pattern).alias(name) for name, pattern in parts.items()])


def write_raw_events(events: DataFrame, path: str, ts: str) -> None:
    """Raw events as snappy Parquet under ``year/month/day/hour``."""
    (
        with_time_parts(events, ts)
        .hint("rebalance", *RAW_EVENTS_LAYOUT)
        .write.mode("append")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", RAW_EVENTS_ROWS_PER_FILE)
        .partitionBy(*RAW_EVENTS_LAYOUT)
        .parquet(path)
    )


def write_feature_updates(updates: DataFrame, path: str, ts: str) -> None:
    """Computed features under ``entity_type/year/month/day``."""
    (
        with_time_parts(updates, ts, hour=False)
        .hint("rebalance", *FEATURE_UPDATES_LAYOUT)
        .write.mode("append")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", FEATURE_UPDATES_ROWS_PER_FILE)
        .partitionBy(*FEATURE_UPDATES_LAYOUT)
        .parquet(path)
    )


def write_messages(messages: DataFrame, path: str) -> None:
    """Keyed JSON messages as lines of text files; to a topic, see ``write_topic``."""
    messages.select(F.to_json(F.struct("key", "value")).alias("value")).write.mode("append").text(path)


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Keyed messages to a Kafka topic (needs Spark's Kafka package)."""
    (
        messages.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .options(**PRODUCER_OPTIONS)
        .save()
    )


# Delivery settings of the producer.
PRODUCER_OPTIONS = {
    "kafka.acks": "all",
    "kafka.enable.idempotence": "true",
    "kafka.retries": "5",
    "kafka.retry.backoff.ms": "200",
    "kafka.compression.type": "snappy",
    "kafka.linger.ms": "5",
    "kafka.batch.size": "65536",
}
