"""From messages to the latest-value table and the dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from freshet.functions.messages import dead_letters, parse_messages, valid_events
from freshet.operators.freshness import TTL_MULTIPLIER, latest_values, with_expiry
from freshet.streaming.batches import triggered, write_batch
from freshet.streaming.latest_table import merge_batch


def start_ingest(
    messages: DataFrame,
    definitions: DataFrame,
    latest_path: str,
    dead_letter_path: str,
    checkpoint: str,
    order: list[str],
    received_at: str = "received_at",
    interval: str | None = None,
    multiplier: int = TTL_MULTIPLIER,
    buckets: int | None = None,
) -> StreamingQuery:
    """Check messages, keep the last event of each key per batch, set its expiry.

    ``messages`` has ``value``, ``received_at`` and whatever ``order`` names
    (event columns or, say, an offset). Valid events go to ``latest_path``,
    rejected messages to ``dead_letter_path``, each into the folder of its
    micro-batch. With ``buckets`` the events are merged into a table of so many
    buckets instead, which ``latest_table.read_table`` reads as it stands. A failing write fails the batch, which is then run again
    from the checkpointed offsets. Counts of processed and failed messages
    are reported with the progress of the query under ``messages``.
    """
    parsed = parse_messages(messages, received_at=received_at).observe(
        "messages",
        F.count_if(F.col("error").isNull()).alias("processed"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_batch(dead_letters(batch), dead_letter_path, batch_id)
            events = valid_events(batch).drop("value", "metadata").withColumnRenamed(received_at, "written_at")
            last = latest_values(events, ["written_at" if c == received_at else c for c in order])
            last = with_expiry(last, definitions, multiplier=multiplier)
            if buckets is None:
                write_batch(last, latest_path, batch_id)
            else:
                merge_batch(last, latest_path, batch_id, ["written_at" if c == received_at else c for c in order], buckets=buckets)
        finally:
            batch.unpersist()

    writer = parsed.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return triggered(writer, interval).start()


def read_latest(spark: SparkSession, path: str, order: list[str]) -> DataFrame:
    """The latest-value table: the per-batch rows folded to one row per key.

    ``order`` is that of the ingest; pass ``["batch_id", ...]`` for arrival
    order. ``compact_latest`` keeps the number of rows to fold small.
    """
    return latest_values(spark.read.parquet(path), order)


def compact_latest(spark: SparkSession, path: str, target: str, order: list[str]) -> None:
    """Write the folded table to a new folder, with the batch ids kept as a column."""
    read_latest(spark, path, order).hint("rebalance").write.mode("errorifexists").parquet(target)


def start_audit(updates: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Append every feature write to the audit log."""
    writer = updates.writeStream.foreachBatch(lambda rows, batch_id: write_batch(rows, path, batch_id))
    return triggered(writer.option("checkpointLocation", checkpoint), interval).start()
