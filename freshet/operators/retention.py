"""Retention by age and compaction of the audit log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions.clock import SECOND, from_micros, instant, micros, type_of
from freshet.operators.freshness import KEY, latest_values

# How long each kind of data is kept, and the compaction lag.
RETENTION_SECONDS = {
    "raw_events": 7 * 86_400,
    "feature_updates": 86_400,
    "dead_letters": 30 * 86_400,
    "audit": 30 * 86_400,
}
COMPACTION_LAG_SECONDS = 3_600


def _before(as_of: str, seconds: int, like: str):
    return from_micros(micros(instant(as_of)) - seconds * SECOND, like)


def retained(rows: DataFrame, ts: str, as_of: str, keep_seconds: int) -> DataFrame:
    """Rows not older than the retention; a literal bound on ``ts`` reaches the scan."""
    return rows.filter(F.col(ts) >= _before(as_of, keep_seconds, type_of(rows, ts)))


def retained_folders(lake: DataFrame, ts: str, as_of: str, keep_seconds: int) -> DataFrame:
    """``retained`` for rows in folders ``year/month/day``: older folders are not read at all.

    The day of the border itself is read and cut by ``ts``.
    """
    border = _before(as_of, keep_seconds, type_of(lake, ts))
    day = F.make_date(*[F.col(part).cast("int") for part in ("year", "month", "day")])
    return retained(lake.filter(day >= border.cast("date")), ts, as_of, keep_seconds)


def expire_lake(lake: DataFrame, target: str, layout: list[str], ts: str, as_of: str, keep_seconds: int) -> None:
    """Write what is retained to a new folder in the same layout; the old one can then be given up whole."""
    kept = retained_folders(lake, ts, as_of, keep_seconds)
    kept.hint("rebalance", *layout).write.mode("errorifexists").partitionBy(*layout).parquet(target)


def compact_log(
    log: DataFrame,
    target: str,
    ts: str,
    order: list[str],
    as_of: str,
    lag_seconds: int = COMPACTION_LAG_SECONDS,
    keep_seconds: int = RETENTION_SECONDS["audit"],
    key: list[str] = KEY,
) -> None:
    """Write the compacted audit log to a new folder."""
    compacted(log, ts, order, as_of, lag_seconds, keep_seconds, key).hint("rebalance").write.mode("errorifexists").parquet(target)


def compacted(
    log: DataFrame,
    ts: str,
    order: list[str],
    as_of: str,
    lag_seconds: int = COMPACTION_LAG_SECONDS,
    keep_seconds: int = RETENTION_SECONDS["audit"],
    key: list[str] = KEY,
) -> DataFrame:
    """The audit log after compaction and expiry.

    Rows within the lag are all kept; of the older ones a key keeps its last,
    whether or not it was written again within the lag.
    """
    like = type_of(log, ts)
    kept = retained(log, ts, as_of, keep_seconds)
    border = _before(as_of, lag_seconds, like)
    old = latest_values(kept.filter(F.col(ts) < border), order, key)
    return kept.filter(F.col(ts) >= border).unionByName(old)
