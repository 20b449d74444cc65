"""Sliding windows asked for at many moments: one closed window that ends at each probe.

Nothing is joined by range. A window's counts, sums and users are what has come
by its end less what has left by then: an event comes at ``ts`` and leaves just
after ``ts + window``, and a user, whose events' windows run together while no
pause is longer than the window, comes with the first and leaves after the
last of each such run. So they are running sums of changes over time, read at the
probes. Time is cut into slices; the sums run within each slice, and over the
slices' totals, one row per slice of ``window / PIECES``.

Extremes can't be taken back. Time is also cut into blocks as long as the window,
so a window is the end of one block and the start of the next: extremes run
forward and backward within the blocks, again by slices.

Work is linear in events and probes, for windows of any length. All that is sorted
together are the events and probes of one slice, after equal times are added up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.clock import SECOND, floor_to, from_micros, micros, type_of
from freshet.operators.sessions import sessions
from freshet.operators.windows import partials, statistics

PIECES = 16

_SUMS = ["n", "n_amount", "total", "users"]


def _extremes(suffix: str = "") -> list[Column]:
    return [F.min("lo").alias(f"lo{suffix}"), F.max("hi").alias(f"hi{suffix}")]


def _changes(events: DataFrame, timed: DataFrame, window_seconds: int) -> DataFrame:
    """``t`` and the changes of n, n_amount, total and users at t; lo and hi of the events at t."""
    window = window_seconds * SECOND
    zero, none = F.lit(0).cast("bigint"), F.lit(None).cast("double")
    come = timed.select("t", "n", "n_amount", "total", zero.alias("users"), "lo", "hi")
    leave = timed.select(
        (F.col("t") + window + 1).alias("t"), (-F.col("n")).alias("n"), (-F.col("n_amount")).alias("n_amount"), (-F.col("total")).alias("total"),
        zero.alias("users"), none.alias("lo"), none.alias("hi"),
    )
    runs = sessions(events.filter(F.col("user_id").isNotNull()), "user_id", "ts", window_seconds)
    ends = runs.select(F.explode(F.array(
        F.struct(micros("session_start").alias("t"), F.lit(1).alias("users")),
        F.struct((micros("session_end") + 1).alias("t"), F.lit(-1).alias("users")),
    )).alias("e"))
    users = ends.groupBy(F.col("e.t").alias("t")).agg(F.sum("e.users").alias("users"))
    users = users.select("t", zero.alias("n"), zero.alias("n_amount"), zero.alias("total"), "users", none.alias("lo"), none.alias("hi"))
    return come.unionByName(leave).unionByName(users)


def _marked(rows: DataFrame, marks: DataFrame, slice_: int) -> DataFrame:
    """Rows and marks in one frame with ``mark`` (1 for a mark) and ``slice``."""
    both = rows.withColumn("mark", F.lit(0)).unionByName(marks.withColumn("mark", F.lit(1)), allowMissingColumns=True)
    return both.withColumn("slice", floor_to(F.col("t"), slice_))


def sliding_probes(events: DataFrame, probes: DataFrame, window_seconds: int, at: str = "at", scale: int = 2) -> DataFrame:
    """The rows of ``probes`` with the statistics of ``[at - window, at]``, both ends included, as ``sliding_at`` gives them.

    Events without a time count nowhere; a probe without one has a null window
    and zeros. Sums run over the whole history, so they need a ``scale``.
    """
    if scale is None:
        raise ValueError("running sums of doubles would not be exact: give a scale")
    like = type_of(probes, at)
    window = window_seconds * SECOND
    slice_ = window // PIECES
    events = events.filter(F.col("ts").isNotNull())
    timed = events.groupBy(micros("ts").alias("t")).agg(*partials(scale))
    asked = probes.select(micros(at).alias("t")).filter("t IS NOT NULL").distinct()

    # What has come and left, and the start of the block that the window ends in.
    rows = _marked(_changes(events, timed, window_seconds), asked, slice_)
    inside = Window.partitionBy("slice").orderBy("t", "mark").rowsBetween(Window.unboundedPreceding, 0)
    running = [F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(c) for c in _SUMS]
    running += [F.min("lo").over(inside).alias("lo"), F.max("hi").over(inside).alias("hi")]
    at_probe = rows.select("t", "mark", "slice", *running).filter("mark = 1").drop("mark")
    slices = rows.groupBy("slice").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _SUMS], *_extremes())
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    in_block = Window.partitionBy(floor_to(F.col("slice"), window)).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = slices.select(
        "slice", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in _SUMS],
        F.min("lo").over(in_block).alias("lo_before"), F.max("hi").over(in_block).alias("hi_before"),
    )
    ends = at_probe.join(before, "slice").select(
        "t", *[(F.col(c) + F.col(f"{c}_before")).alias(c) for c in _SUMS],
        F.least("lo", "lo_before").alias("lo_end"), F.greatest("hi", "hi_before").alias("hi_end"),
    )

    # The end of the block that the window starts in.
    rows = _marked(timed.select("t", "lo", "hi"), asked.select((F.col("t") - window).alias("t")), slice_)
    inside = Window.partitionBy("slice").orderBy(F.desc("t"), "mark").rowsBetween(Window.unboundedPreceding, 0)
    at_start = rows.select("t", "mark", "slice", F.min("lo").over(inside).alias("lo"), F.max("hi").over(inside).alias("hi")).filter("mark = 1")
    slices = rows.groupBy("slice").agg(*_extremes())
    in_block = Window.partitionBy(floor_to(F.col("slice"), window)).orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    after = slices.select("slice", F.min("lo").over(in_block).alias("lo_after"), F.max("hi").over(in_block).alias("hi_after"))
    starts = at_start.join(after, "slice").select(
        (F.col("t") + window).alias("t"), F.least("lo", "lo_after").alias("lo_start"), F.greatest("hi", "hi_after").alias("hi_start")
    )

    found = ends.join(starts, "t").select(
        F.col("t").alias("__t"), *_SUMS, F.least("lo_end", "lo_start").alias("lo"), F.greatest("hi_end", "hi_start").alias("hi")
    )
    shown = found.select("__t", *statistics(scale))
    met = probes.join(shown, micros(F.col(at)) == F.col("__t"), "left")
    return met.select(
        *[probes[c] for c in probes.columns],
        from_micros(F.col("__t") - window, like).alias("window_start"),
        from_micros(F.col("__t"), like).alias("window_end"),
        *[F.coalesce(F.col(c), F.lit(0).cast(shown.schema[c].dataType)).alias(c) for c in shown.columns if c != "__t"],
    )
