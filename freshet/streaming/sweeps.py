"""Periodic freshness sweeps over the latest-value table."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from freshet.operators.due import SLICE_SECONDS, due_sweep, entries_between, last_sweep
from freshet.operators.freshness import monitored, sla_sweep, sweep_log_rows

# Fixed value: pause between two sweeps.
SWEEP_INTERVAL = "15 seconds"


def sweep_once(latest: DataFrame, definitions: DataFrame, as_of: str, log_path: str, sweep_id: str | None = None) -> None:
    """Check all visible values at ``as_of`` and log one row per feature.

    A sweep owns the folder ``sweep_id=...`` (named by its moment if no id is
    given) and replaces it when it is run again, so nothing is counted twice.
    """
    _log(sla_sweep(monitored(latest, definitions, as_of)), as_of, log_path, sweep_id)


def sweep_due(
    spark: SparkSession,
    entries_path: str,
    definitions: DataFrame,
    as_of: str,
    log_path: str,
    slice_seconds: int = SLICE_SECONDS,
    sweep_id: str | None = None,
) -> None:
    """As ``sweep_once``, from the index of due moments: only entries since the last logged sweep are read.

    ``as_of`` is at or after the arrival of all batches in the index. A sweep that runs
    again builds on the one before it, as it did the first time.
    """
    since, last = last_sweep(spark, log_path, as_of)
    entries = entries_between(spark, entries_path, since, as_of, slice_seconds)
    _log(due_sweep(entries, last, definitions), as_of, log_path, sweep_id)


def _log(sweep: DataFrame, as_of: str, log_path: str, sweep_id: str | None) -> None:
    own = sweep_id or f"at-{re.sub('[^0-9]', '', as_of)}"
    (
        sweep_log_rows(sweep, as_of)
        .withColumn("sweep_id", F.lit(own))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("sweep_id")
        .parquet(log_path)
    )


def start_sweeps(
    spark: SparkSession,
    read_latest: Callable[[], DataFrame],
    read_definitions: Callable[[], DataFrame],
    log_path: str,
    checkpoint: str,
    interval: str = SWEEP_INTERVAL,
) -> StreamingQuery:
    """Sweep at every trigger; the moment of a sweep is the newest tick of its batch."""

    def sweep(ticks: DataFrame, batch_id: int) -> None:
        at = ticks.agg({"timestamp": "max"}).first()[0]
        if at is not None:
            sweep_once(read_latest(), read_definitions(), at.isoformat(sep=" "), log_path, f"batch-{batch_id}")

    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (
        ticks.writeStream.foreachBatch(sweep)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=interval)
        .start()
    )
