"""Streams into date-partitioned Parquet.

Before it is written a micro-batch is brought together by folder, so that it
leaves a few files in each and not one of every task; a folder with very many
rows is split. A micro-batch owns ``batch_id=<n>`` in the folders it writes to
and replaces it when it is run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from freshet.sources.sinks import (
    FEATURE_UPDATES_LAYOUT,
    FEATURE_UPDATES_ROWS_PER_FILE,
    RAW_EVENTS_LAYOUT,
    RAW_EVENTS_ROWS_PER_FILE,
    with_time_parts,
)
from freshet.streaming.batches import triggered

# How often each sink writes.
RAW_EVENTS_INTERVAL = "10 minutes"
FEATURE_UPDATES_INTERVAL = "5 minutes"


def _start(rows: DataFrame, path: str, checkpoint: str, layout: list[str], per_file: int, interval: str | None):
    def store(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
            .hint("rebalance", *layout)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", "snappy")
            .option("maxRecordsPerFile", per_file)
            .partitionBy(*layout, "batch_id")
            .parquet(path)
        )

    writer = rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return triggered(writer, interval).start()


def start_raw_events(
    events: DataFrame, path: str, checkpoint: str, ts: str, interval: str | None = RAW_EVENTS_INTERVAL
) -> StreamingQuery:
    """Raw events under ``year/month/day/hour`` of their event time."""
    return _start(
        with_time_parts(events, ts), path, checkpoint, RAW_EVENTS_LAYOUT, RAW_EVENTS_ROWS_PER_FILE, interval
    )


def start_feature_updates(
    updates: DataFrame, path: str, checkpoint: str, ts: str, interval: str | None = FEATURE_UPDATES_INTERVAL
) -> StreamingQuery:
    """Computed features (with ``entity_type``) under ``entity_type/year/month/day``."""
    return _start(
        with_time_parts(updates, ts, hour=False),
        path,
        checkpoint,
        FEATURE_UPDATES_LAYOUT,
        FEATURE_UPDATES_ROWS_PER_FILE,
        interval,
    )
