"""Profiles, differences and the history of feature table snapshots.

A snapshot is a Parquet folder of its own, ``snapshot_id=<id>``, plus one row
in a log of commits. The log is a table of events (``commit`` and
``rollback``); the current snapshot is the target of the last event, so
nothing is ever rewritten, and a rollback brings the rows of then back.
"""

from __future__ import annotations

import hashlib
import json
import secrets
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from freshet.functions.amounts import mean, sample_std, square_sum, units
from freshet.session import shared_dir

STAT = "mean: double, std: double, min: double, max: double"
LOG_SCHEMA = (
    "event_type string, event_at string, snapshot_id string, label string, created_at string, location string, "
    f"schema_hash string, row_count bigint, stats map<string, struct<{STAT}>>, parent_snapshot_id string"
)
SKIPPED_COLUMNS = ["event_date"]


# --- profiles -----------------------------------------------------------------


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in SKIPPED_COLUMNS]


def schema_hash(df: DataFrame) -> str:
    """Fingerprint of names and types; the order of the columns does not count."""
    fields = sorted((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    return hashlib.sha256(json.dumps(fields).encode()).hexdigest()[:16]


def profile(df: DataFrame, scale: int | None = None, columns: list[str] | None = None) -> DataFrame:
    """``column_name, row_count, mean, std, min, max`` of each numeric column.

    One pass with one partial aggregate per task. With a ``scale`` the values
    are added as decimals, which makes the result repeatable to the last bit.
    """
    names = columns or numeric_columns(df)
    if not names:
        return df.agg(F.count("*").alias("row_count")).select(
            F.lit(None).cast("string").alias("column_name"),
            "row_count",
            *[F.lit(0.0).alias(s) for s in ("mean", "std", "min", "max")],
        ).filter(F.lit(False))

    parts = [F.count("*").alias("row_count")]
    for i, name in enumerate(names):
        parts += [F.min(name).alias(f"lo_{i}"), F.max(name).alias(f"hi_{i}")]
        if scale is None:
            parts += [F.avg(name).alias(f"mean_{i}"), F.stddev_samp(name).alias(f"std_{i}")]
        else:
            value = units(name, scale)
            parts += [F.count(name).alias(f"n_{i}"), F.sum(value).alias(f"s1_{i}"), square_sum(value, scale).alias(f"s2_{i}")]

    def stat(i: int, name: str):
        if scale is None:
            center, spread = F.col(f"mean_{i}"), F.col(f"std_{i}")
        else:
            n, s1, s2 = F.col(f"n_{i}"), F.col(f"s1_{i}"), F.col(f"s2_{i}")
            center, spread = mean(s1, n, scale), sample_std(n, s1, s2, scale)
        values = {"mean": center, "std": spread, "min": F.col(f"lo_{i}"), "max": F.col(f"hi_{i}")}
        return F.struct(
            F.lit(name).alias("column_name"),
            "row_count",
            *[F.coalesce(v.cast("double"), F.lit(0.0)).alias(k) for k, v in values.items()],
        )

    stats = F.array(*[stat(i, n) for i, n in enumerate(names)])
    return df.agg(*parts).select(F.explode(stats).alias("s")).select("s.*")


def profile_diff(profile_a: DataFrame, profile_b: DataFrame) -> DataFrame:
    """Per column: the statistics of both sides and ``b - a``; 0 where a side lacks the column.

    Profiles have one row per column of a table, so the join is small.
    """
    stats = ("mean", "std", "min", "max")

    def side(p: DataFrame, tag: str) -> DataFrame:
        return p.select("column_name", *[F.col(s).alias(f"{s}_{tag}") for s in stats])

    both = side(profile_a, "a").join(side(profile_b, "b"), "column_name", "full_outer")
    columns = []
    for s in stats:
        a, b = (F.coalesce(F.col(f"{s}_{t}"), F.lit(0.0)) for t in "ab")
        columns += [a.alias(f"{s}_a"), b.alias(f"{s}_b"), F.round(b - a, 4).alias(f"{s}_delta")]
    return both.select(F.col("column_name").alias("feature"), *columns)


def drift_series(rows: DataFrame, snapshot: str, column: str, scale: int | None = None) -> DataFrame:
    """Mean and deviation of a column per snapshot, with the change of the mean since the one before."""
    value = units(column, scale)
    if scale is None:
        stats = rows.groupBy(snapshot).agg(
            F.count("*").alias("row_count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std")
        )
    else:
        stats = rows.groupBy(snapshot).agg(
            F.count("*").alias("row_count"),
            F.count(column).alias("n"),
            F.sum(value).alias("s1"),
            square_sum(value, scale).alias("s2"),
        )
        stats = stats.select(
            snapshot,
            "row_count",
            mean(F.col("s1"), F.col("n"), scale).alias("mean"),
            sample_std(F.col("n"), F.col("s1"), F.col("s2"), scale).alias("std"),
        )
    # one row per snapshot
    series = Window.orderBy(snapshot)
    return stats.select(
        "*",
        F.round(F.col("mean") - F.lag("mean").over(series), 4).alias("mean_delta"),
    )


# --- the log --------------------------------------------------------------------


def new_snapshot_id(now: datetime | None = None) -> str:
    """Id in order of time: the moment to the microsecond, and a random end."""
    moment = now or datetime.now(timezone.utc)
    return moment.astimezone(timezone.utc).strftime("s%Y%m%dT%H%M%S.%f-") + secrets.token_hex(4)


def read_log(spark: SparkSession, log_path: str) -> DataFrame:
    """The event log; empty as long as nothing was committed."""
    try:
        return spark.read.schema(LOG_SCHEMA).json(log_path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def snapshot_states(log: DataFrame) -> DataFrame:
    """One row per snapshot, ``is_current`` and ``status`` taken from the last event."""
    last = log.agg(F.max_by("snapshot_id", F.struct("event_at", "snapshot_id")).alias("id")).scalar()
    current = F.coalesce(F.col("snapshot_id") == last, F.lit(False))
    return log.filter(F.col("event_type") == "commit").select(
        *[c for c in log.columns if c not in ("event_type", "event_at")],
        current.alias("is_current"),
        F.when(current, "current").otherwise("archived").alias("status"),
    )


def list_snapshots(log: DataFrame) -> DataFrame:
    return snapshot_states(log).orderBy(F.col("created_at").desc(), F.col("snapshot_id").desc())


def get_snapshot(log: DataFrame, snapshot_id: str) -> DataFrame:
    return snapshot_states(log).filter(F.col("snapshot_id") == snapshot_id)


def current_snapshot(log: DataFrame) -> DataFrame:
    return snapshot_states(log).filter("is_current").limit(1)


def lineage(log: DataFrame, snapshot_id: str | None = None, max_depth: int = 100_000) -> DataFrame:
    """A snapshot (default: the current one) and its ancestors, ``depth`` 0 first.

    The parent is the snapshot that was current at the commit, which after a
    rollback is not the one before in time. The walk reads the links once from
    a written copy, not the log anew at each level; it ends where the links
    do, and with an error beyond ``max_depth``.
    """
    states = snapshot_states(log)
    spark = log.sparkSession
    path = f"{shared_dir(spark)}/links-{uuid.uuid4().hex}"
    states.select("snapshot_id", "parent_snapshot_id", "label", "row_count", "is_current").write.parquet(path)
    states = spark.read.parquet(path)
    start = states.filter("is_current") if snapshot_id is None else states.filter(F.col("snapshot_id") == snapshot_id)
    nodes = states.drop("is_current")
    return spark.sql(
        f"""
        WITH RECURSIVE chain MAX RECURSION LEVEL {int(max_depth)} AS (
            SELECT n.*, 0 AS depth FROM {{nodes}} n WHERE n.snapshot_id IN (SELECT snapshot_id FROM {{start}})
            UNION ALL
            SELECT p.*, c.depth + 1 FROM chain c JOIN {{nodes}} p ON p.snapshot_id = c.parent_snapshot_id
        )
        SELECT * FROM chain
        """,
        nodes=nodes,
        start=start.select("snapshot_id"),
    )


def current_at_each_commit(events: DataFrame) -> DataFrame:
    """Fills ``parent_snapshot_id`` of commit events in a bare event log.

    ``events`` has ``event_at, event_type, snapshot_id``; the parent of a
    commit is the target of the event before it. The log is metadata with one
    row per commit or rollback.
    """
    order = Window.orderBy("event_at", "snapshot_id")
    return events.withColumn("before", F.lag("snapshot_id").over(order)).select(
        *events.columns,
        F.when(F.col("event_type") == "commit", F.col("before")).alias("parent_snapshot_id"),
    )


def _moment(at: datetime | None) -> str:
    """Text in the order of time: UTC, to the microsecond. A moment without a zone is taken as UTC."""
    at = at or datetime.now(timezone.utc)
    at = at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at.astimezone(timezone.utc)
    return at.isoformat(timespec="microseconds")


def snapshot_folder(log_path: str, snapshot_id: str) -> str:
    """Where the rows of a snapshot are kept: next to the log."""
    return f"{log_path.rstrip('/')}.data/snapshot_id={snapshot_id}"


def read_snapshot(spark: SparkSession, log_path: str, snapshot_id: str | None = None) -> DataFrame:
    """The rows of a snapshot, by default of the current one."""
    log = read_log(spark, log_path)
    wanted = current_snapshot(log) if snapshot_id is None else get_snapshot(log, snapshot_id)
    row = wanted.select("location").first()
    if row is None:
        raise ValueError("nothing is committed yet" if snapshot_id is None else f"no commit has the id {snapshot_id!r}")
    return spark.read.parquet(row["location"])


def _append(spark: SparkSession, log_path: str, row: dict) -> None:
    values = tuple(row.get(name) for name in T._parse_datatype_string(LOG_SCHEMA).names)
    spark.createDataFrame([values], LOG_SCHEMA).coalesce(1).write.mode("append").json(log_path)


def commit_snapshot(
    spark: SparkSession,
    data_path: str,
    log_path: str,
    label: str = "",
    snapshot_id: str | None = None,
    at: datetime | None = None,
    on_missing: str = "raise",
) -> str:
    """Keep the rows of a Parquet folder and append a commit; it becomes the current snapshot.

    The rows are copied to the snapshot's own folder first, so that later
    writes to ``data_path`` don't reach them; a commit that failed halfway is
    not in the log and may be run again under its id. An id that is in the log
    is refused. ``on_missing="empty"`` commits an unreadable path with no rows
    and no statistics. Only one row per numeric column comes to the driver.
    """
    at = at or datetime.now(timezone.utc)
    snapshot_id = snapshot_id or new_snapshot_id(at)
    log = read_log(spark, log_path)
    if not get_snapshot(log, snapshot_id).isEmpty():
        raise ValueError(f"the id {snapshot_id!r} is taken")
    parent = current_snapshot(log).select("snapshot_id").first()
    location = data_path
    rows, stats, fingerprint = 0, {}, hashlib.sha256(b"[]").hexdigest()[:16]
    try:
        data = spark.read.parquet(data_path)
    except AnalysisException as error:
        if on_missing != "empty" or error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    else:
        fingerprint = schema_hash(data)
        location = snapshot_folder(log_path, snapshot_id)
        data.write.mode("overwrite").parquet(location)
        # the profile is that of what was kept
        data = spark.read.schema(data.schema).parquet(location)
        described = profile(data).collect()
        rows = described[0]["row_count"] if described else data.count()
        stats = {r["column_name"]: (r["mean"], r["std"], r["min"], r["max"]) for r in described} if rows else {}
    _append(
        spark,
        log_path,
        {
            "event_type": "commit",
            "event_at": _moment(at),
            "snapshot_id": snapshot_id,
            "label": label,
            "created_at": _moment(at),
            "location": location,
            "schema_hash": fingerprint,
            "row_count": rows,
            "stats": stats,
            "parent_snapshot_id": parent["snapshot_id"] if parent else None,
        },
    )
    return snapshot_id


def rollback_snapshot(spark: SparkSession, log_path: str, snapshot_id: str, at: datetime | None = None) -> None:
    """Make an earlier snapshot current again; the history stays."""
    if get_snapshot(read_log(spark, log_path), snapshot_id).isEmpty():
        raise ValueError(f"no commit has the id {snapshot_id!r}")
    _append(spark, log_path, {"event_type": "rollback", "event_at": _moment(at), "snapshot_id": snapshot_id})


def snapshot_diff(log: DataFrame, snap_a: str, snap_b: str) -> tuple[DataFrame, DataFrame]:
    """Two committed snapshots: one header row, and one row per feature.

    The header tells whether the schema changed and how the row count moved.
    Ids that were never committed are an error.
    """
    commits = log.filter(F.col("event_type") == "commit")
    for snapshot_id in (snap_a, snap_b):
        if commits.filter(F.col("snapshot_id") == snapshot_id).isEmpty():
            raise ValueError(f"no commit has the id {snapshot_id!r}")

    def of(snapshot_id: str, name: str):
        return F.max(F.when(F.col("snapshot_id") == snapshot_id, F.col(name)))

    header = (
        commits.filter(F.col("snapshot_id").isin(snap_a, snap_b))
        .agg(
            *[
                of(snapshot_id, name).alias(f"{name}_{tag}")
                for name in ("schema_hash", "row_count")
                for tag, snapshot_id in (("a", snap_a), ("b", snap_b))
            ]
        )
        .select(
            F.lit(snap_a).alias("snap_a"),
            F.lit(snap_b).alias("snap_b"),
            (F.col("schema_hash_a") != F.col("schema_hash_b")).alias("schema_changed"),
            "schema_hash_a",
            "schema_hash_b",
            "row_count_a",
            "row_count_b",
            (F.col("row_count_b") - F.col("row_count_a")).alias("row_count_delta"),
        )
    )

    def stats(snapshot_id: str) -> DataFrame:
        return (
            commits.filter(F.col("snapshot_id") == snapshot_id)
            .select(F.explode("stats").alias("column_name", "s"))
            .select("column_name", "s.*")
        )

    return header, profile_diff(stats(snap_a), stats(snap_b))
