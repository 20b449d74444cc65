"""Features over a trailing window of time or of rows.

A plain ``Window.partitionBy(entity)`` would put all rows of an entity in one
task and, with a sliding frame, walk the whole frame for every row. Here an
entity's history is cut into time buckets that are sorted on their own, and a
bucket with very many rows into runs (see ``runs``); what came before is
brought in as one carry row per bucket or run. Carry rows come from totals,
which are combined map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.amounts import amount as as_amount
from freshet.functions.amounts import mean, units
from freshet.functions.clock import DAY, SECOND, instant, micros, type_of
from freshet.operators.runs import ROWS_PER_RUN, hot_starts, with_runs

# kinds of rows inside a bucket, in the order in which they are applied
_CARRY, _ROW, _EXPIRY = 0, 1, 2


def trailing_totals(
    rows: DataFrame,
    entity: str,
    ts: str,
    width_seconds: int,
    amount: str | None = None,
    scale: int = 2,
    bucket_seconds: int = DAY,
    rows_per_run: int = ROWS_PER_RUN,
) -> DataFrame:
    """Adds ``trailing_count`` (and ``trailing_sum``) over ``[ts - width, ts]``.

    Both ends of the window count, and so do rows with an equal time. Every
    row adds itself when it happens and takes itself back just after it has
    left the window, so the window is a running total: linear in the rows for
    any width. Sums are exact, hence taking back leaves no residue. Rows
    without a time get NULL.
    """
    width, bucket = width_seconds * SECOND, bucket_seconds * SECOND
    value = F.coalesce(units(amount, scale), F.lit(0)) if amount else None

    def moves(source: DataFrame, payload: bool) -> DataFrame:
        def move(kind: int, t: Column, sign: int) -> Column:
            fields = [F.lit(kind).alias("kind"), t.alias("t"), F.lit(sign).cast("long").alias("dn")]
            if value is not None:
                fields.append((value * F.lit(sign)).alias("ds"))
            if payload:
                row = F.struct(*[F.col(c) for c in source.columns])
                fields.append((row if kind == _ROW else F.lit(None).cast(source.schema)).alias("row"))
            return F.struct(*fields)

        t = micros(ts)
        both = F.array(move(_ROW, t, 1), move(_EXPIRY, t + F.lit(width + 1), -1))
        return (
            source.select(F.col(entity).alias("entity"), F.explode(both).alias("m"))
            .select("entity", "m.*")
        )

    starts = hot_starts(moves(rows, payload=False), bucket, rows_per_run)
    totals = ["dn"] + (["ds"] if amount else [])
    per_bucket = with_runs(moves(rows, payload=False), bucket, starts).groupBy("entity", "bucket").agg(*[F.sum(c).alias(c) for c in totals])
    before = Window.partitionBy("entity").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(
        "entity",
        F.lit(_CARRY).alias("kind"),
        F.col("bucket").alias("t"),
        *[F.sum(c).over(before).alias(c) for c in totals],
        F.lit(None).cast(rows.schema).alias("row"),
        "bucket",
    )
    running = (
        Window.partitionBy("entity", "bucket").orderBy("t").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    out = (
        with_runs(moves(rows, payload=True), bucket, starts)
        .unionByName(carry)
        .select("kind", "t", "row", *[F.sum(c).over(running).alias(c) for c in totals])
        .filter(F.col("kind") == _ROW)
    )
    known = F.col("t").isNotNull()
    columns = [F.col("row.*"), F.when(known, F.col("dn")).alias("trailing_count")]
    if amount:
        columns.append(F.when(known, as_amount(F.col("ds"), scale)).alias("trailing_sum"))
    return out.select(*columns)


def numbered(
    rows: DataFrame, entity: str, ts: str, tie: str, bucket_seconds: int = 30 * DAY, rows_per_run: int = ROWS_PER_RUN
) -> DataFrame:
    """Adds ``position``: 1, 2, 3, ... per entity in the order of (ts, tie)."""
    bucket = bucket_seconds * SECOND
    keyed = rows.select(
        F.col(entity).alias("entity"), micros(ts).alias("t"), F.struct(*[F.col(c) for c in rows.columns]).alias("row")
    )
    keyed = with_runs(keyed, bucket, hot_starts(keyed.select("entity", "t"), bucket, rows_per_run))
    per_bucket = keyed.groupBy("entity", "bucket").agg(F.count("*").alias("step"))
    before = Window.partitionBy("entity").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(
        "entity",
        "bucket",
        F.lit(_CARRY).alias("kind"),
        F.coalesce(F.sum("step").over(before), F.lit(0)).alias("step"),
        F.lit(None).cast(rows.schema).alias("row"),
    )
    body = keyed.select(
        "entity", "bucket", F.lit(_ROW).alias("kind"), F.lit(1).cast("long").alias("step"), "row"
    )
    running = (
        Window.partitionBy("entity", "bucket")
        .orderBy("kind", F.col(f"row.{ts}"), F.col(f"row.{tie}"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        body.unionByName(carry)
        .select("kind", "row", F.sum("step").over(running).alias("position"))
        .filter(F.col("kind") == _ROW)
        .select("row.*", "position")
    )


def last_rows_mean(
    rows: DataFrame,
    entity: str,
    ts: str,
    tie: str,
    amount: str,
    n: int,
    scale: int | None = 2,
    bucket_seconds: int = 30 * DAY,
    run_length: int = ROWS_PER_RUN,
) -> DataFrame:
    """Adds ``trailing_mean`` over the row itself and the ``n - 1`` before it.

    Rows are numbered per entity and cut into runs of ``run_length`` positions;
    the last ``n - 1`` rows of a run are also sent to the next one, so a task
    gets at most ``run_length + n - 1`` rows of an entity.
    """
    if not 1 <= n <= run_length:
        raise ValueError("n must be between 1 and run_length")
    placed = numbered(rows, entity, ts, tie, bucket_seconds, run_length)
    zero_based = F.col("position") - 1
    run = (zero_based - F.pmod(zero_based, F.lit(run_length))) / run_length
    needed_next = F.pmod(zero_based, F.lit(run_length)) >= run_length - (n - 1)
    runs = F.when(needed_next, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    spread = placed.select("*", run.cast("long").alias("own_run"), F.explode(runs).alias("ahead"))
    spread = spread.withColumn("run", F.col("own_run") + F.col("ahead"))
    frame = Window.partitionBy(entity, "run").orderBy("position").rowsBetween(-(n - 1), 0)
    return (
        spread.withColumn("trailing_mean", mean(F.sum(units(amount, scale)).over(frame), F.count(amount).over(frame), scale))
        .filter(F.col("ahead") == 0)
        .drop("own_run", "ahead", "run", "position")
    )


def latest_rows_mean(
    rows: DataFrame, entity: str, ts: str, tie: str, amount: str, n: int, scale: int | None = 2
) -> DataFrame:
    """Mean amount of the ``n`` newest rows of each entity.

    The rank filter is applied before the shuffle as well, so each task passes
    on at most ``n`` rows per entity.
    """
    newest = Window.partitionBy(entity).orderBy(F.col(ts).desc(), F.col(tie).desc())
    return (
        rows.select(entity, ts, tie, amount)
        .withColumn("rank", F.row_number().over(newest))
        .filter(F.col("rank") <= n)
        .groupBy(entity)
        .agg(
            mean(F.sum(units(amount, scale)), F.count(amount), scale).alias("latest_mean"),
            F.count("*").alias("rows_used"),
        )
    )


def days_since_last(rows: DataFrame, entity: str, ts: str, as_of: str) -> DataFrame:
    """Days from the newest row of each entity up to ``as_of``."""
    now = instant(as_of, type_of(rows, ts))
    return (
        rows.filter(F.col(ts) <= now)
        .groupBy(entity)
        .agg(F.max(ts).alias("last_ts"))
        .withColumn(
            "days_since_last",
            (micros(now) - micros("last_ts")) / F.lit(float(DAY * SECOND)),
        )
    )
