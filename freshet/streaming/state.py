"""The state of a stream's aggregate, read as a table.

A stateful query keeps one row per key in its checkpoint. That is the current
result as of its last finished batch, so it can be read as it stands instead of
folding what the query has written. Needs a query with one aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from freshet.operators.freshness import KEY
from freshet.streaming.batches import triggered


def finished_batch(spark: SparkSession, checkpoint: str) -> int:
    """The last batch whose state is complete."""
    return spark.read.format("state-metadata").load(checkpoint).agg(F.max("maxBatchId")).first()[0]


def read_state(spark: SparkSession, checkpoint: str, keys: str, values: str, batch_id: int | None = None) -> DataFrame:
    """One row per key as of a finished batch; ``keys`` and ``values`` name and type the columns in their order in the state."""
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    rows = reader.load(checkpoint)
    named = rows.select(F.col("key").cast(f"struct<{keys}>").alias("k"), F.col("value").cast(f"struct<{values}>").alias("v"))
    return named.select("k.*", "v.*")


def start_latest_state(
    events: DataFrame, order: list[str], checkpoint: str, key: list[str] = KEY, interval: str | None = None
) -> StreamingQuery:
    """Keep the last event of each key, by ``order``, in the state alone; nothing is written elsewhere.

    The state has a row per key and grows with the keys, not with the events.
    """
    writer = _latest(events, order, key).writeStream.outputMode("update").format("noop")
    return triggered(writer.option("checkpointLocation", checkpoint), interval).start()


def _latest(events: DataFrame, order: list[str], key: list[str]) -> DataFrame:
    rest = F.struct(*[F.col(c) for c in events.columns if c not in key])
    return events.groupBy(*key).agg(F.max_by(rest, _place(order)).alias("last"))


def _place(order: list[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def read_latest_state(
    spark: SparkSession, checkpoint: str, events: DataFrame, order: list[str], key: list[str] = KEY, batch_id: int | None = None
) -> DataFrame:
    """What ``start_latest_state`` keeps, in the columns of ``events``, whose schema is that of the stream."""
    kind = events.select(*key).schema.simpleString()[len("struct<") : -1]
    last = events.select(F.struct(*[F.col(c) for c in events.columns if c not in key]).alias("last"), _place(order).alias("place"))
    values = last.schema.simpleString()[len("struct<") : -1]
    return read_state(spark, checkpoint, kind, values, batch_id).select(*key, "last.*")
