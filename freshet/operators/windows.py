"""Tumbling and sliding window aggregates over an event stream at rest.

Every result row has ``window_start, window_end, count, total_amount,
avg_amount, min_amount, max_amount, unique_users``; amounts are rounded to two
digits. Input: ``ts, user_id, amount``.

Events are reduced per (window or class of windows, user) first. This step is
combined map-side and makes the exact user count a plain count, so a window
that holds a third of all events is no single task's burden.
"""

from __future__ import annotations

from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.amounts import rounded_amount, rounded_mean, units
from freshet.functions.clock import SECOND, ceil_to, floor_to, from_micros, instant, micros, type_of

TUMBLING_SECONDS = {"1min": 60, "5min": 300, "1hr": 3600}

STATISTICS = ["count", "total_amount", "avg_amount", "min_amount", "max_amount", "unique_users"]


def partials(scale: int | None) -> list[Column]:
    return [
        F.count("*").alias("n"),
        F.count("amount").alias("n_amount"),
        F.sum(units("amount", scale)).alias("total"),
        F.min("amount").alias("lo"),
        F.max("amount").alias("hi"),
    ]


def merged() -> list[Column]:
    return [
        F.sum("n").alias("n"),
        F.sum("n_amount").alias("n_amount"),
        F.sum("total").alias("total"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
    ]


def statistics(scale: int | None) -> list[Column]:
    """Output columns; a window without events shows zeros."""
    zero = F.lit(0.0)
    return [
        F.coalesce("n", F.lit(0)).alias("count"),
        F.coalesce(rounded_amount(F.col("total"), 2, scale), zero).alias("total_amount"),
        F.coalesce(rounded_mean(F.col("total"), F.col("n_amount"), 2, scale), zero).alias("avg_amount"),
        F.coalesce(F.round("lo", 2), zero).alias("min_amount"),
        F.coalesce(F.round("hi", 2), zero).alias("max_amount"),
        F.coalesce("users", F.lit(0)).alias("unique_users"),
    ]


def count_users(per_user: DataFrame, keys: list[str]) -> DataFrame:
    """From one row per (window, user) to one row per window."""
    return per_user.groupBy(*keys).agg(*merged(), F.count("user_id").alias("users"))


def tumbling_partials(events: DataFrame, size_seconds: int, scale: int | None = 2) -> DataFrame:
    """One row per (window, user); the streaming form keeps exactly these."""
    return (
        events.groupBy(F.window("ts", f"{size_seconds} seconds").alias("w"), "user_id")
        .agg(*partials(scale))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "user_id",
                "n", "n_amount", "total", "lo", "hi")
    )


def finish(per_user: DataFrame, scale: int | None = 2, keys: list[str] | None = None) -> DataFrame:
    keys = keys or ["window_start", "window_end"]
    return count_users(per_user, keys).select(*keys, *statistics(scale))


def tumbling(events: DataFrame, size_seconds: int, scale: int | None = 2) -> DataFrame:
    """Windows ``[start, start + size)`` aligned to the epoch."""
    return finish(tumbling_partials(events, size_seconds, scale), scale)


def in_order(found: DataFrame, *by: str) -> DataFrame:
    """Windows in order of their start: ranges of starts are dealt to the tasks and sorted there, so no task has them all."""
    return found.orderBy("window_start", *by)


def sliding_at(events: DataFrame, at: str, window_seconds: int, scale: int | None = 2) -> DataFrame:
    """The one window ``[at - window, at]``, both ends included.

    The bounds are literals of the column's own type and reach the scan.
    """
    like = type_of(events, "ts")
    end = instant(at, like)
    start = from_micros(micros(end) - window_seconds * SECOND, like)
    return (
        events.filter(F.col("ts").between(start, end))
        .groupBy("user_id")
        .agg(*partials(scale))
        .agg(*merged(), F.count("user_id").alias("users"))
        .select(start.alias("window_start"), end.alias("window_end"), *statistics(scale))
    )


def sliding_at_latest(events: DataFrame, window_seconds: int, scale: int | None = 2) -> DataFrame:
    """As ``sliding_at`` at the time of the newest event."""
    newest = events.agg(F.max("ts").alias("end")).scalar()
    start = from_micros(micros(newest) - window_seconds * SECOND, type_of(events, "ts"))
    return (
        events.filter(F.col("ts") >= start)
        .groupBy("user_id")
        .agg(*partials(scale))
        .agg(*merged(), F.count("user_id").alias("users"))
        .select(start.alias("window_start"), newest.alias("window_end"), *statistics(scale))
    )


def sliding_classes(window_seconds: int, step_seconds: int) -> list[Column]:
    """First and last start, in multiples of the step, of the closed windows around an event."""
    window, step = window_seconds * SECOND, step_seconds * SECOND
    t = micros("ts")
    return [ceil_to(t - window, step).alias("first_start"), floor_to(t, step).alias("last_start")]


def sliding_class_partials(
    events: DataFrame, window_seconds: int, step_seconds: int, scale: int | None = 2
) -> DataFrame:
    """One row per (class of windows, user); the streaming form keeps exactly these."""
    return events.groupBy(*sliding_classes(window_seconds, step_seconds), "user_id").agg(
        *partials(scale), F.min(micros("ts")).alias("t_first"), F.max(micros("ts")).alias("t_last")
    )


def new_to(start: Column, previous: Column) -> Column:
    """1 if a user's row brings the user into a window that the row before didn't reach."""
    return F.when(F.col("user_id").isNotNull() & F.coalesce(start > previous, F.lit(True)), 1).otherwise(0)


def by_user(rows: DataFrame, *order: str) -> DataFrame:
    """Adds ``previous``, the struct of ``order`` of the row of the same user before.

    A user has one row per class of windows, so their number is bounded by the
    covered time and not by the events.
    """
    over = Window.partitionBy("user_id").orderBy(*order)
    return rows.withColumn("previous", F.lag(F.struct(*order)).over(over))


def sliding_from_classes(classes: DataFrame, step_seconds: int) -> DataFrame:
    """One row per (window start, class, user), with ``users``: 1 in the first of a user's rows in that window.

    Events that fall into the same windows form a class; the class is reduced
    before it is spread over its windows, so the spread does not multiply
    events but (class, user) rows. Since a user's classes run forward in time, a
    window holds the user already if the class before reaches it; so users are
    counted by adding up, and the spread rows are combined map-side.
    """
    starts = F.explode(F.sequence("first_start", "last_start", F.lit(step_seconds * SECOND)))
    return (
        by_user(classes, "first_start", "last_start")
        .filter(F.col("first_start") <= F.col("last_start"))
        .withColumn("start", starts)
        .select("start", new_to(F.col("start"), F.col("previous.last_start")).alias("users"), "n", "n_amount", "total", "lo", "hi")
    )


def add_up(spread: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    return spread.groupBy(*keys).agg(*merged(), F.sum("users").alias("users"), *more)


def in_series(spread: DataFrame, series: DataFrame, keys: list[str]) -> DataFrame:
    """``add_up`` over the windows of the series, those without a row too; other windows have a null ``in_series``.

    ``series`` has the keys. Its windows come along as rows without events, so
    that nothing is joined.
    """
    kinds = dict(spread.dtypes)
    sums = [c for c in spread.columns if c not in keys]
    nothing = [(F.lit(0) if c in ("n", "users") else F.lit(None)).cast(kinds[c]).alias(c) for c in sums]
    marked = spread.withColumn("listed", F.lit(None).cast("boolean"))
    rows = marked.unionByName(series.select(*keys, *nothing, F.lit(True).alias("listed")))
    return add_up(rows, keys, F.max("listed").alias("in_series"))


def _first_and_last_start(lo: Column, hi: Column, window: int, step: int) -> tuple[Column, Column]:
    return ceil_to(lo, step), floor_to(hi + step - window, step)


def series_bounds(
    rows: DataFrame, window: int, step: int, first_t: Column | None = None, last_t: Column | None = None
) -> tuple[Column, Column]:
    """First and last window start of the series as scalar subqueries."""
    first_t = micros("ts") if first_t is None else first_t
    last_t = micros("ts") if last_t is None else last_t
    span = rows.agg(F.min(first_t).alias("lo"), F.max(last_t).alias("hi"))
    first, last = _first_and_last_start(F.col("lo"), F.col("hi"), window, step)
    return span.select(first).scalar(), span.select(last).scalar()


def sliding_series(
    events: DataFrame,
    window_seconds: int = 300,
    step_seconds: int = 60,
    scale: int | None = 2,
    include_empty: bool = True,
    tail_seconds: int | None = None,
) -> DataFrame:
    """All windows ``[start, start + window]``, both ends included.

    Starts run over the multiples of ``step`` from the first event on, as long
    as the window ends at most one step after the last event. Windows without
    events are part of the series unless ``include_empty`` is off.
    ``tail_seconds`` keeps only the events of the last so many seconds, which
    is what a bounded buffer would have kept.
    """
    like = type_of(events, "ts")
    if tail_seconds is not None:
        newest = events.agg(F.max("ts").alias("x")).scalar()
        events = events.filter(micros("ts") >= micros(newest) - tail_seconds * SECOND)
    window, step = window_seconds * SECOND, step_seconds * SECOND
    classes = sliding_class_partials(events, window_seconds, step_seconds, scale)
    spread = sliding_from_classes(classes, step_seconds)
    if include_empty:
        folded = in_series(spread, series_starts(events, window, step), ["start"]).filter("in_series")
    else:
        folded = add_up(spread, ["start"]).filter(F.col("start").between(*series_bounds(events, window, step)))
    return folded.select(
        from_micros(F.col("start"), like).alias("window_start"),
        from_micros(F.col("start") + window, like).alias("window_end"),
        *statistics(scale),
    )


def finish_sliding(
    classes: DataFrame, window_seconds: int, step_seconds: int, like: str, scale: int | None = 2
) -> DataFrame:
    """The sliding series of the events in the classes, empty windows included."""
    series = series_starts(classes, window_seconds * SECOND, step_seconds * SECOND, F.col("t_first"), F.col("t_last"))
    folded = in_series(sliding_from_classes(classes, step_seconds), series, ["start"]).filter("in_series")
    return folded.select(
        from_micros(F.col("start"), like).alias("window_start"),
        from_micros(F.col("start") + window_seconds * SECOND, like).alias("window_end"),
        *statistics(scale),
    )


def series_starts(
    rows: DataFrame,
    window: int,
    step: int,
    first_t: Column | None = None,
    last_t: Column | None = None,
    chunk: int = 1000,
) -> DataFrame:
    """Every window start of the series, made in chunks that spread over the tasks."""
    first_t = micros("ts") if first_t is None else first_t
    last_t = micros("ts") if last_t is None else last_t
    first, last = _first_and_last_start(F.col("lo"), F.col("hi"), window, step)
    span = rows.agg(F.min(first_t).alias("lo"), F.max(last_t).alias("hi")).select(
        first.alias("first"), last.alias("last")
    )
    chunks = span.filter(F.col("first") <= F.col("last")).select(
        "last", F.explode(F.sequence("first", "last", F.lit(step * chunk))).alias("from")
    )
    until = F.least(F.col("from") + step * (chunk - 1), F.col("last"))
    return chunks.repartition("from").select(F.explode(F.sequence("from", until, F.lit(step))).alias("start"))


def pane_seconds(sizes: dict[str, int]) -> int:
    return reduce(gcd, sizes.values())


def pane_partials(
    events: DataFrame, sizes: dict[str, int], window_seconds: int, step_seconds: int, scale: int | None = 2
) -> DataFrame:
    """One row per (pane, user): what all window kinds have in common.

    A pane is the common divisor of the tumbling sizes within one class of
    sliding windows.
    """
    pane = pane_seconds(sizes) * SECOND
    return events.groupBy(
        floor_to(micros("ts"), pane).alias("pane"), *sliding_classes(window_seconds, step_seconds), "user_id"
    ).agg(*partials(scale), F.min(micros("ts")).alias("t_first"), F.max(micros("ts")).alias("t_last"))


def evictable_panes(events: DataFrame, pane_seconds: int, window_seconds: int, step_seconds: int, scale: int | None = 2) -> DataFrame:
    """The rows of ``pane_partials`` as a stream can drop them: panes are time windows, so a watermark ends them."""
    panes = events.groupBy(F.window("ts", f"{pane_seconds} seconds").alias("w"), *sliding_classes(window_seconds, step_seconds), "user_id").agg(
        *partials(scale), F.min(micros("ts")).alias("t_first"), F.max(micros("ts")).alias("t_last")
    )
    return panes.withColumn("pane", micros("w.start")).drop("w")


def windows_from_panes(
    panes: DataFrame,
    series: DataFrame,
    like: str,
    sizes: dict[str, int],
    window_seconds: int,
    step_seconds: int,
    scale: int | None = 2,
) -> DataFrame:
    """Spread the panes over the windows they belong to and reduce, tagged with ``window_type``.

    ``series`` has the starts of the sliding windows, those without events included.
    """
    window, step = window_seconds * SECOND, step_seconds * SECOND

    lengths = [*[size * SECOND for size in sizes.values()], window]
    names = [*sizes, "sliding"]

    # a slot is the number of the window kind, the start, and whether the user is new there; the rest follows from these
    def slot(kind: int, start: Column, new: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), new.alias("users"))

    def tumbler(kind: int, length: int) -> Column:
        start = floor_to(F.col("pane"), length)
        return slot(kind, start, new_to(start, floor_to(F.col("previous.pane"), length)))

    tumblers = F.array(*[tumbler(i, length) for i, length in enumerate(lengths[:-1])])
    starts = F.when(
        F.col("first_start") <= F.col("last_start"), F.sequence("first_start", "last_start", F.lit(step))
    ).otherwise(F.array().cast("array<bigint>"))
    sliders = F.transform(starts, lambda s: slot(len(sizes), s, new_to(s, F.col("previous.last_start"))))
    sums = ["n", "n_amount", "total", "lo", "hi"]
    spread = by_user(panes, "pane", "first_start", "last_start").select(F.explode(F.concat(tumblers, sliders)).alias("s"), *sums)
    spread = spread.select("s.*", *sums)
    slots = series.select(F.lit(len(sizes)).alias("kind"), "start")
    kind = F.col("kind") + 1
    end = F.col("start") + F.element_at(F.array(*[F.lit(length) for length in lengths]), kind)
    return (
        in_series(spread, slots, ["kind", "start"])
        .filter((F.col("kind") != len(sizes)) | F.col("in_series"))
        .select(
            F.element_at(F.array(*[F.lit(name) for name in names]), kind).alias("window_type"),
            from_micros(F.col("start"), like).alias("window_start"),
            from_micros(end, like).alias("window_end"),
            *statistics(scale),
        )
    )


def multi_resolution(
    events: DataFrame,
    sizes: dict[str, int] | None = None,
    window_seconds: int = 300,
    step_seconds: int = 60,
    scale: int | None = 2,
) -> DataFrame:
    """All tumbling sizes and the sliding series, empty windows included, of one pass over the events."""
    sizes = sizes or TUMBLING_SECONDS
    return windows_from_panes(
        pane_partials(events, sizes, window_seconds, step_seconds, scale),
        series_starts(events, window_seconds * SECOND, step_seconds * SECOND),
        type_of(events, "ts"),
        sizes,
        window_seconds,
        step_seconds,
        scale,
    )
