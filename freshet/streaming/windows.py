"""Window aggregates over a stream.

State is kept per (window or pane, user): sums, counts and extremes of fixed
size, never a set of users. Each micro-batch writes the rows it changed; the
readers take the newest row of each (window, user) and finish the aggregate
with the same code as the batch form. Without a watermark late events are
always accepted, and the state keeps all panes. With one, a pane is sealed when the
watermark passes its end: it leaves the state, is appended once to the table of
sealed panes, and events that come later for it are dropped. The readers unite
the sealed panes with the open ones, which they read from the state of the same
batch, so the state holds the panes of the delay however long the stream runs.
"""

from __future__ import annotations

from math import gcd

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from freshet.functions.clock import SECOND, micros
from freshet.operators import windows as batch
from freshet.operators.freshness import latest_values
from freshet.streaming.batches import triggered, write_batch
from freshet.streaming.state import finished_batch, read_state

WINDOW_KEY = ["window_start", "window_end", "user_id"]
PANE_KEY = ["pane", "first_start", "last_start", "user_id"]


def _watermarked(events: DataFrame, delay: str | None) -> DataFrame:
    return events.withWatermark("ts", delay) if delay else events


def _start(changes: DataFrame, path: str, checkpoint: str, interval: str | None, mode: str = "update") -> StreamingQuery:
    writer = (
        changes.writeStream.outputMode(mode)
        .foreachBatch(lambda rows, batch_id: write_batch(rows, path, batch_id))
        .option("checkpointLocation", checkpoint)
    )
    return triggered(writer, interval).start()


def _sealed_and_open(spark: SparkSession, path: str, checkpoint: str) -> DataFrame:
    """Panes as of the last finished batch; a pane may be in several rows by user and class, each once."""
    batch_id = finished_batch(spark, checkpoint)
    user = _user_type(spark, checkpoint, batch_id)
    keys = f"w: struct<start: timestamp, end: timestamp>, first_start: bigint, last_start: bigint, user_id: {user}"
    values = "n: bigint, n_amount: bigint, total: {}, lo: double, hi: double, t_first: bigint, t_last: bigint"
    total = spark.read.format("statestore").option("batchId", batch_id).load(checkpoint).schema["value"].dataType[2].dataType.simpleString()
    rows = read_state(spark, checkpoint, keys, values.format(total), batch_id)
    open_ = rows.withColumn("pane", micros("w.start")).drop("w")
    try:
        sealed = spark.read.parquet(path).filter(F.col("batch_id") <= batch_id).drop("batch_id")
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return open_  # nothing is sealed yet
    return sealed.unionByName(open_)


def _user_type(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    key = spark.read.format("statestore").option("batchId", batch_id).load(checkpoint).schema["key"].dataType
    return key["user_id"].dataType.simpleString()


def start_tumbling(
    events: DataFrame,
    size_seconds: int,
    path: str,
    checkpoint: str,
    delay: str | None = None,
    scale: int | None = 2,
    interval: str | None = None,
) -> StreamingQuery:
    """Tumbling windows of ``ts, user_id, amount``; ``ts`` must be a ``timestamp`` if a delay is given."""
    partials = batch.tumbling_partials(_watermarked(events, delay), size_seconds, scale)
    return _start(partials, path, checkpoint, interval)


def read_tumbling(spark: SparkSession, path: str, scale: int | None = 2) -> DataFrame:
    newest = latest_values(spark.read.parquet(path), ["batch_id"], WINDOW_KEY)
    return batch.finish(newest, scale)


def closed_tumbling(events: DataFrame, size_seconds: int, delay: str, scale: int | None = 2) -> DataFrame:
    """A stream of finished windows: each once, after the watermark has passed its end."""
    per_user = (
        events.withWatermark("ts", delay)
        .groupBy(F.window("ts", f"{size_seconds} seconds"), "user_id")
        .agg(*batch.partials(scale))
    )
    return batch.count_users(per_user, ["window"]).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *batch.statistics(scale)
    )


def start_multi_resolution(
    events: DataFrame,
    path: str,
    checkpoint: str,
    window_seconds: int = 300,
    step_seconds: int = 60,
    scale: int | None = 2,
    interval: str | None = None,
    delay: str | None = None,
) -> StreamingQuery:
    """Panes that serve all tumbling sizes and the sliding windows; with a delay ``ts`` must be a ``timestamp``."""
    if delay:
        panes = batch.evictable_panes(_watermarked(events, delay), batch.pane_seconds(batch.TUMBLING_SECONDS), window_seconds, step_seconds, scale)
        return _start(panes, path, checkpoint, interval, "append")
    panes = batch.pane_partials(events, batch.TUMBLING_SECONDS, window_seconds, step_seconds, scale)
    return _start(panes, path, checkpoint, interval)


def read_multi_resolution(
    spark: SparkSession,
    path: str,
    window_seconds: int = 300,
    step_seconds: int = 60,
    scale: int | None = 2,
    like: str = "timestamp",
    checkpoint: str | None = None,
) -> DataFrame:
    """``checkpoint`` is that of a query with a delay."""
    if checkpoint:
        panes = _sealed_and_open(spark, path, checkpoint)
    else:
        panes = latest_values(spark.read.parquet(path), ["batch_id"], PANE_KEY)
    series = batch.series_starts(
        panes, window_seconds * SECOND, step_seconds * SECOND, F.col("t_first"), F.col("t_last")
    )
    return batch.windows_from_panes(panes, series, like, batch.TUMBLING_SECONDS, window_seconds, step_seconds, scale)


def start_sliding(
    events: DataFrame,
    path: str,
    checkpoint: str,
    window_seconds: int = 300,
    step_seconds: int = 60,
    scale: int | None = 2,
    interval: str | None = None,
    delay: str | None = None,
) -> StreamingQuery:
    """Sliding windows alone, kept as classes of events that share their windows; with a delay ``ts`` must be a ``timestamp``."""
    if delay:
        panes = batch.evictable_panes(_watermarked(events, delay), gcd(window_seconds, step_seconds), window_seconds, step_seconds, scale)
        return _start(panes, path, checkpoint, interval, "append")
    classes = batch.sliding_class_partials(events, window_seconds, step_seconds, scale)
    return _start(classes, path, checkpoint, interval)


def read_sliding(
    spark: SparkSession,
    path: str,
    window_seconds: int = 300,
    step_seconds: int = 60,
    scale: int | None = 2,
    like: str = "timestamp",
    checkpoint: str | None = None,
) -> DataFrame:
    """The sliding series over all events so far, as the batch form gives it; ``checkpoint`` is that of a query with a delay."""
    if checkpoint:
        return batch.finish_sliding(_sealed_and_open(spark, path, checkpoint), window_seconds, step_seconds, like, scale)
    classes = latest_values(spark.read.parquet(path), ["batch_id"], ["first_start", "last_start", "user_id"])
    return batch.finish_sliding(classes, window_seconds, step_seconds, like, scale)
