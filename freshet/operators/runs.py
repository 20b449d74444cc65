"""Cuts the history of an entity into runs that fit a task.

A history is cut into time buckets. A bucket with more rows than a run may
have is cut again, by the number of its rows: rows are counted in fine slices
of the bucket, and a new run starts whenever the rows before it fill one more
run. Only rows of the same slice stay together, however many they are. A run
is named by the time at which it starts, so runs of an entity are in order of
their names and every row of a run is at or after it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.clock import floor_to
from freshet.operators.joins import attach, dimension
from freshet.session import shared_dir

ROWS_PER_RUN = 100_000
SLICES_PER_BUCKET = 65_536
MAX_BROADCAST_SLICES = 1_000_000


def hot_starts(keyed: DataFrame, width: int, rows_per_run: int = ROWS_PER_RUN) -> DataFrame | None:
    """``entity, bucket, slice, start`` of the slices of buckets beyond ``rows_per_run`` rows; None if there is none.

    ``keyed`` has ``entity`` and ``t`` in microseconds, as ``width`` is. Counts
    are combined map-side, and slices are counted in hot buckets only. The
    starts are written once to the shared folder, so all that use them cut
    alike; a bucket has at most ``SLICES_PER_BUCKET`` rows there.
    """
    placed = keyed.select("entity", "t", floor_to(F.col("t"), width).alias("bucket"))
    hot = placed.groupBy("entity", "bucket").agg(F.count("*").alias("n_rows")).filter(F.col("n_rows") > rows_per_run)
    if hot.isEmpty():
        return None
    sliced = (
        attach(placed, hot, ["entity", "bucket"], "inner")
        .groupBy("entity", "bucket", _slice(width).alias("slice"))
        .agg(F.count("*").alias("n"))
    )
    before = Window.partitionBy("entity", "bucket").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    full = F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / rows_per_run)
    starts = sliced.withColumn("run", full).select(
        "entity", "bucket", "slice", F.min("slice").over(Window.partitionBy("entity", "bucket", "run")).alias("start")
    )
    path = f"{shared_dir(keyed.sparkSession)}/runs-{uuid.uuid4().hex}"
    starts.write.parquet(path)
    return keyed.sparkSession.read.parquet(path)


def _slice(width: int) -> Column:
    """Start of the slice of its bucket that a row lies in."""
    return F.col("bucket") + floor_to(F.col("t") - F.col("bucket"), max(1, -(-width // SLICES_PER_BUCKET)))


def with_runs(rows: DataFrame, width: int, starts: DataFrame | None) -> DataFrame:
    """Adds ``bucket``, the start of the run that a row of ``entity`` at ``t`` belongs to.

    A row finds its run by its slice, in one equi-join whatever the number of
    runs. The slices are broadcast if their number and size allow, else joined by
    shuffle, with adaptive execution splitting the hot keys.
    """
    placed = rows.withColumn("bucket", floor_to(F.col("t"), width))
    if starts is None:
        return placed
    cut = attach(placed.withColumn("slice", _slice(width)), dimension(starts, MAX_BROADCAST_SLICES), ["entity", "bucket", "slice"])
    return cut.withColumn("bucket", F.coalesce("start", "bucket")).drop("slice", "start")
