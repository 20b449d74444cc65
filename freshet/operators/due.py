"""Sweeps that read only what falls due: an index of when totals change.

A stored value adds one to its feature's total when it arrives, one to the stale
count when it outgrows its limit, and takes both back when it expires or is
replaced. All these moments but the last are known when it arrives; a
replacement takes back what the old value had added, and unsays what it would
have added later. So the index holds entries (feature, moment, change of total,
change of stale) that are only ever appended, in folders by slice of time. A sweep
adds the entries since the last one to the last totals, and reads no value.

A value is stale from the microsecond after ``event_ts`` + limit. Limits are those
of the moment of arrival: after a change of limits the index is to be made anew.
Entries never lie before the arrival of their batch, so a sweep at or after that
moment misses none.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.clock import SECOND, floor_to, instant, micros
from freshet.operators.freshness import active
from freshet.operators.joins import dimension

SLICE_SECONDS = 60
_ENTRY = "array<struct<at: bigint, total: bigint, stale: bigint>>"


def _entry(at: Column, total: Column | int, stale: Column | int) -> Column:
    return F.struct(at.alias("at"), F.lit(total).cast("bigint").alias("total"), F.lit(stale).cast("bigint").alias("stale"))


def _contributions(value: str, arrival: Column, sla: Column, expiring: bool) -> Column:
    """Entries of a value that arrives and is never replaced; ``value`` names a struct with event_ts and expires_at."""
    due = micros(F.col(f"{value}.event_ts")) + sla.cast("bigint") * SECOND + 1
    stale_from = F.greatest(arrival, F.when(F.col(f"{value}.event_ts").isNotNull(), due))
    stale_from = F.when(F.col(f"{value}.event_ts").isNotNull(), stale_from)
    none = F.array().cast(_ENTRY)
    arrives = F.array(_entry(arrival, 1, 0))
    if not expiring:
        return F.concat(arrives, F.when(stale_from.isNotNull(), F.array(_entry(stale_from, 0, 1))).otherwise(none))
    gone = micros(F.col(f"{value}.expires_at"))
    in_time = F.coalesce(stale_from < gone, F.lit(False))
    whole = F.concat(
        arrives,
        F.when(in_time, F.array(_entry(stale_from, 0, 1))).otherwise(none),
        F.array(_entry(gone, -1, -in_time.cast("bigint"))),
    )
    return F.when(gone > arrival, whole).otherwise(none)


def due_entries(changes: DataFrame, definitions: DataFrame, arrived_at: str, expiring: bool = False) -> DataFrame:
    """``feature_name, at, total, stale`` of changed keys: ``feature_name``, ``new`` and ``old`` (null if there was none).

    ``at`` is in microseconds. Summed per feature and moment, map-side first.
    """
    slas = active(definitions).select("feature_name", F.col("expected_freshness_seconds").alias("sla"))
    moment = micros(instant(arrived_at))
    before = F.lit(-(2**62)).cast("bigint")  # the old value was there already
    sla = F.col("sla")
    taken_back = F.transform(
        _contributions("old", before, sla, expiring), lambda e: _entry(F.greatest(e["at"], moment), -e["total"], -e["stale"])
    )
    both = F.concat(
        _contributions("new", moment, sla, expiring),
        F.when(F.col("old").isNotNull(), taken_back).otherwise(F.array().cast(_ENTRY)),
    )
    found = changes.join(dimension(slas), "feature_name").select("feature_name", F.explode(both).alias("e"))
    summed = found.groupBy("feature_name", F.col("e.at").alias("at")).agg(F.sum("e.total").alias("total"), F.sum("e.stale").alias("stale"))
    return summed.filter("total <> 0 OR stale <> 0")


def write_entries(entries: DataFrame, path: str, batch_id: int, slice_seconds: int = SLICE_SECONDS) -> None:
    """Append a batch's entries, in folders by slice; a batch that runs again replaces its own."""
    (
        entries.withColumn("slice", floor_to(F.col("at"), slice_seconds * SECOND))
        .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .repartition("slice")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("slice", "batch_id")
        .parquet(path)
    )


def entries_between(spark: SparkSession, path: str, since: str | None, until: str, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Entries after ``since`` and not after ``until``; only the folders of these slices are read."""
    width = slice_seconds * SECOND
    end = micros(instant(until))
    rows = spark.read.parquet(path).filter((F.col("slice") <= floor_to(end, width)) & (F.col("at") <= end))
    if since is None:
        return rows
    start = micros(instant(since))
    return rows.filter((F.col("slice") >= floor_to(start, width)) & (F.col("at") > start))


def due_sweep(entries: DataFrame, last: DataFrame | None, definitions: DataFrame) -> DataFrame:
    """The rows of ``sla_sweep``: the last sweep's totals and the entries since, added up per feature."""
    rows = entries.select("feature_name", "total", "stale")
    if last is not None:
        rows = rows.unionByName(last.select("feature_name", F.col("total_count").alias("total"), F.col("stale_count").alias("stale")))
    sums = rows.groupBy("feature_name").agg(F.sum("stale").alias("stale_count"), F.sum("total").alias("total_count"))
    slas = active(definitions).select("feature_name", F.col("expected_freshness_seconds").alias("sla_seconds"))
    found = sums.filter("total_count > 0").join(dimension(slas), "feature_name")
    return found.select("feature_name", "sla_seconds", "stale_count", "total_count")


def last_sweep(spark: SparkSession, log_path: str, before: str) -> tuple[str | None, DataFrame | None]:
    """Moment and rows of the newest logged sweep before a moment."""
    try:
        log = spark.read.parquet(log_path).filter(F.col("swept_at") < instant(before))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None, None
        raise
    at = log.agg(F.max("swept_at").cast("string")).first()[0]
    return at, None if at is None else log.filter(F.col("swept_at") == instant(at))
