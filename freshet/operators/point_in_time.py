"""Training rows that see only what was known at the time of the label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.clock import DAY, SECOND, micros
from freshet.operators.runs import ROWS_PER_RUN, hot_starts, with_runs

_CARRY, _FEATURE, _LABEL = 0, 1, 2


def point_in_time(
    labels: DataFrame,
    features: DataFrame,
    entity: str,
    ts: str,
    tie: str,
    value: str,
    feature_name: str | None = None,
    names: list[str] | None = None,
    bucket_seconds: int = DAY,
    rows_per_run: int = ROWS_PER_RUN,
) -> DataFrame:
    """Each label with the newest feature value at or before its time.

    Adds ``feature_value`` and ``feature_ts``; with ``feature_name`` and
    ``names`` adds ``<name>`` and ``<name>_ts`` for each named feature. Of two
    features with the same time the larger ``tie`` wins. A label without an
    earlier feature keeps NULLs.

    Labels and features are merged in time order, so no label is paired with
    more than its one match. A history is cut into time buckets that are
    sorted apart, and a bucket with very many rows into runs (see ``runs``);
    the last value before enters as a carry row.
    """
    if (feature_name is None) != (names is None):
        raise ValueError("give feature_name and names together")
    wanted = names or ["feature_value"]
    bucket = bucket_seconds * SECOND

    # fields are compared in order: time, then tie
    seen = F.struct(micros(ts).alias("t"), F.col(tie).alias("tie"), F.col(ts).alias("ts"), F.col(value).alias("value"))

    def payload(name: str) -> Column:
        return seen if feature_name is None else F.when(F.col(feature_name) == name, seen)

    slots = [f"slot_{i}" for i in range(len(wanted))]
    known = features if feature_name is None else features.filter(F.col(feature_name).isin(wanted))
    points = known.filter(F.col(ts).isNotNull()).select(
        F.col(entity).alias("entity"),
        micros(ts).alias("t"),
        F.col(tie).alias("tie"),
        F.lit(_FEATURE).alias("kind"),
        *[payload(n).alias(s) for n, s in zip(wanted, slots)],
        F.lit(None).cast(labels.schema).alias("label"),
    )
    empty = {s: F.lit(None).cast(points.schema[s].dataType).alias(s) for s in slots}
    asks = labels.select(
        F.col(entity).alias("entity"),
        micros(ts).alias("t"),
        F.lit(None).cast(points.schema["tie"].dataType).alias("tie"),
        F.lit(_LABEL).alias("kind"),
        *[empty[s] for s in slots],
        F.struct(*[F.col(c) for c in labels.columns]).alias("label"),
    )

    starts = hot_starts(points.select("entity", "t").unionByName(asks.select("entity", "t")), bucket, rows_per_run)
    per_bucket = (
        with_runs(points.select("entity", "t", *slots).unionByName(asks.select("entity", "t", *slots)), bucket, starts)
        .groupBy("entity", "bucket")
        .agg(*[F.max(s).alias(s) for s in slots])
    )
    before = Window.partitionBy("entity").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = per_bucket.select(
        "entity",
        F.col("bucket").alias("t"),
        F.lit(None).cast(points.schema["tie"].dataType).alias("tie"),
        F.lit(_CARRY).alias("kind"),
        *[F.last(s, ignorenulls=True).over(before).alias(s) for s in slots],
        F.lit(None).cast(labels.schema).alias("label"),
        "bucket",
    )
    merged = with_runs(points.unionByName(asks), bucket, starts).unionByName(carry)
    upto = (
        Window.partitionBy("entity", "bucket")
        .orderBy("t", "kind", "tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # a carry row sits at the start of its bucket, before all kinds at that time
    filled = merged.select(
        "kind", "label", *[F.last(s, ignorenulls=True).over(upto).alias(s) for s in slots]
    ).filter(F.col("kind") == _LABEL)
    ts_names = ["feature_ts"] if names is None else [f"{n}_ts" for n in names]
    return filled.select(
        "label.*",
        *[F.col(f"{s}.value").alias(n) for n, s in zip(wanted, slots)],
        *[F.col(f"{s}.ts").alias(n) for n, s in zip(ts_names, slots)],
    )
