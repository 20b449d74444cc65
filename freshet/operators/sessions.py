"""Sessions: runs of rows of a user with no pause longer than ``gap``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.clock import SECOND, floor_to, from_micros, micros, type_of


def sessions(rows: DataFrame, user: str, ts: str, gap_seconds: int) -> DataFrame:
    """``user, session_start, session_end, event_count`` per session.

    A row exactly ``gap`` after the one before it still belongs to its session,
    as in Spark's own session windows; ``session_end`` is the last row plus the
    gap.

    Rows of a user within one slice of the length of the gap are never further
    apart than the gap. So each slice is reduced to its first and last time,
    map-side, before anything is sorted; a user's slices, whose number is
    bounded by the covered time however many rows there are, are then merged.
    """
    like = type_of(rows, ts)
    gap = gap_seconds * SECOND
    timed = rows.filter(F.col(ts).isNotNull()).select(F.col(user).alias("user"), micros(ts).alias("t"))
    runs = timed.groupBy("user", floor_to(F.col("t"), max(gap, 1)).alias("slice")).agg(
        F.min("t").alias("first"), F.max("t").alias("last"), F.count("*").alias("n")
    )
    over = Window.partitionBy("user").orderBy("first")
    merged = (
        runs.withColumn("opens", (F.col("first") - F.lag("last").over(over) > gap).cast("int"))
        .withColumn("session", F.sum(F.coalesce("opens", F.lit(1))).over(over))
        .groupBy("user", "session")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("event_count"))
    )
    return merged.select(
        F.col("user").alias(user),
        from_micros(F.col("first"), like).alias("session_start"),
        from_micros(F.col("last") + gap, like).alias("session_end"),
        "event_count",
    )


def session_counts(
    rows: DataFrame,
    user: str,
    ts: str,
    gap_seconds: int,
    window_seconds: int = 3600,
) -> DataFrame:
    """Sessions with activity in each tumbling window, per user.

    A session counts in every window between its first and its last row.
    """
    like = type_of(rows, ts)
    found = sessions(rows, user, ts, gap_seconds)
    width = window_seconds * SECOND
    first = floor_to(micros("session_start"), width)
    last = floor_to(micros("session_end") - gap_seconds * SECOND, width)
    return (
        found.select(user, F.explode(F.sequence(first, last, F.lit(width))).alias("w"))
        .groupBy(user, "w")
        .agg(F.count("*").alias("session_count"))
        .select(
            user,
            from_micros(F.col("w"), like).alias("window_start"),
            from_micros(F.col("w") + width, like).alias("window_end"),
            "session_count",
        )
    )


def active_sessions(rows: DataFrame, user: str, ts: str, gap_seconds: int, as_of: str, lookback_seconds: int = 3600) -> DataFrame:
    """Sessions of each user with a row in ``[as_of - lookback, as_of]``."""
    like = type_of(rows, ts)
    now = F.lit(str(as_of)).cast("timestamp")
    begin = from_micros(micros(now) - lookback_seconds * SECOND, like)
    recent = rows.filter(F.col(ts).between(begin, now.cast(like)))
    return (
        sessions(recent, user, ts, gap_seconds)
        .groupBy(user)
        .agg(F.count("*").alias("session_count"))
    )
