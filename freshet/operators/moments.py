"""Profiles from stored moments: any set of snapshots without reading their rows.

When a snapshot is written, one row per group of its rows and numeric column
keeps the number of values, their mean, their squared distances from it, and
the extremes. Moments of two groups combine into those of both (Chan's rule: the
distances add up, and so do the distances of the means from the common mean,
weighted by the numbers), so the profile, the difference and the drift of any
sets of snapshots come from a table with a row per snapshot, group and column.

With a ``scale`` sums and squares are kept in exact units instead, which add up
to the same bits as ``profile`` has; beyond 38 digits a sum stops the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from freshet.functions.amounts import mean, sample_std, square_sum, units
from freshet.operators.snapshots import numeric_columns


def moments(df: DataFrame, by: list[str] | None = None, scale: int | None = None, columns: list[str] | None = None) -> DataFrame:
    """Per group of ``by`` and numeric column: row_count, n, lo, hi, and mean and m2, or s1 and s2 in units.

    One pass with one partial aggregate per task and group.
    """
    by = by or []
    names = columns or [c for c in numeric_columns(df) if c not in by]
    parts, stats = [F.count("*").alias("row_count")], []
    for i, name in enumerate(names):
        value = units(name, scale)
        parts += [F.count(name).alias(f"n_{i}"), F.min(name).cast("double").alias(f"lo_{i}"), F.max(name).cast("double").alias(f"hi_{i}")]
        if scale is None:
            # The population variance is m2 / n.
            parts += [F.avg(value).alias(f"mean_{i}"), (F.var_pop(value) * F.count(name)).alias(f"m2_{i}")]
        else:
            parts += [F.sum(value).cast("decimal(38,0)").alias(f"s1_{i}"), square_sum(value, scale).cast("decimal(38,0)").alias(f"s2_{i}")]
        kept = ("n", "lo", "hi", "mean", "m2") if scale is None else ("n", "lo", "hi", "s1", "s2")
        stats.append(F.struct(F.lit(name).alias("column_name"), "row_count", *[F.col(f"{k}_{i}").alias(k) for k in kept]))
    if not stats:
        raise ValueError("no numeric column")
    return df.groupBy(*by).agg(*parts).select(*by, F.explode(F.array(*stats)).alias("s")).select(*by, "s.*")


def write_moments(df: DataFrame, path: str, snapshot_id: str, scale: int | None = None) -> None:
    """Store the moments of a snapshot; one that is written again replaces its own."""
    found = moments(df, scale=scale).withColumn("snapshot_id", F.lit(snapshot_id))
    found.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_id").parquet(path)


def read_moments(spark: SparkSession, path: str, snapshots: list[str] | None = None) -> DataFrame:
    """The stored moments, of some snapshots or all; ids are read as text."""
    fields = [StructField(f.name, StringType()) if f.name == "snapshot_id" else f for f in spark.read.parquet(path).schema.fields]
    rows = spark.read.schema(StructType(fields)).parquet(path)
    return rows if snapshots is None else rows.filter(F.col("snapshot_id").isin(snapshots))


def merged(rows: DataFrame, by: list[str], scale: int | None = None) -> DataFrame:
    """Moments of the union of all groups with the same ``by`` and column."""
    key = [*by, "column_name"]
    common = [F.sum("row_count").alias("row_count"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")]
    if scale is not None:
        return rows.groupBy(*key).agg(*common, F.sum("s1").alias("s1"), F.sum("s2").alias("s2"))
    # A window over stored groups: one row per snapshot, group and column.
    over = Window.partitionBy(*key)
    center = F.try_divide(F.sum(F.col("n") * F.col("mean")).over(over), F.sum("n").over(over))
    spread = rows.withColumn("center", center).withColumn("apart", F.col("n") * (F.col("mean") - F.col("center")) ** 2)
    return spread.groupBy(*key).agg(
        *common, F.first("center").alias("mean"), (F.coalesce(F.sum("m2"), F.lit(0.0)) + F.coalesce(F.sum("apart"), F.lit(0.0))).alias("m2")
    )


def _statistics(scale: int | None) -> dict[str, Column]:
    if scale is None:
        center, spread = F.col("mean"), F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1)))
    else:
        center, spread = mean(F.col("s1"), F.col("n"), scale), sample_std(F.col("n"), F.col("s1"), F.col("s2"), scale)
    return {"mean": center, "std": spread, "min": F.col("lo"), "max": F.col("hi")}


def merged_profile(rows: DataFrame, scale: int | None = None) -> DataFrame:
    """As ``profile`` of all rows behind the moments."""
    found = merged(rows, [], scale)
    return found.select("column_name", "row_count", *[F.coalesce(v, F.lit(0.0)).alias(k) for k, v in _statistics(scale).items()])


def merged_drift(rows: DataFrame, column: str, snapshot: str = "snapshot_id", scale: int | None = None) -> DataFrame:
    """As ``drift_series`` of a column over the snapshots behind the moments."""
    found = merged(rows.filter(F.col("column_name") == column), [snapshot], scale)
    stats = _statistics(scale)
    series = found.select(snapshot, "row_count", stats["mean"].alias("mean"), stats["std"].alias("std"))
    # One row per snapshot.
    return series.withColumn("mean_delta", F.round(F.col("mean") - F.lag("mean").over(Window.orderBy(snapshot)), 4))
