"""The merged latest-value table, and sweeps by due time, batch by batch."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from freshet.operators import due, freshness
from freshet.plans import queries
from freshet.streaming import latest_table, sweeps

ORDER = ["event_ts", "offset"]
DAY = "2024-01-01"


def batch(spark, *rows):
    """rows: (entity, feature, value, minute of the event or None, minute of expiry, offset)"""

    def at(minute):
        return None if minute is None else f"{DAY} {minute // 60:02d}:{minute % 60:02d}:00"

    made = [(e, f, v, at(m), at(x), o) for e, f, v, m, x, o in rows]
    text = spark.createDataFrame(made, "entity_id string, feature_name string, value_raw string, a string, b string, `offset` long")
    stamped = text.withColumns({"event_ts": F.col("a").cast("timestamp"), "expires_at": F.col("b").cast("timestamp")})
    return stamped.select("entity_id", "feature_name", "value_raw", "event_ts", "expires_at", "offset")


def stored(spark, path):
    return sorted((r["entity_id"], r["feature_name"], r["value_raw"], r["batch_id"]) for r in latest_table.read_table(spark, path).collect())


def random_batches(spark, n, keys=40, per_batch=60):
    rows = spark.range(n * per_batch).withColumn("batch", (F.col("id") / per_batch).cast("int"))
    moment = F.col("id") * 13 + F.pmod(F.xxhash64("id"), F.lit(4000))
    return rows.select(
        "batch",
        F.concat(F.lit("e"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(keys))).alias("entity_id"),
        F.element_at(F.array(F.lit("click"), F.lit("view"), F.lit("unknown")), (F.pmod("id", F.lit(3)) + 1).cast("int")).alias("feature_name"),
        F.col("id").cast("string").alias("value_raw"),
        F.when(F.pmod("id", F.lit(17)) > 0, F.timestamp_seconds(F.lit(1_704_067_200) + moment)).alias("event_ts"),
        F.timestamp_seconds(F.lit(1_704_067_200) + moment + 1500).alias("expires_at"),
        F.col("id").alias("offset"),
    )


def test_the_newest_row_of_each_key_stays(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(ValueError):
        latest_table.read_table(spark, path)
    assert latest_table.merge_batch(batch(spark, ("a", "f", "1", 10, 20, 1), ("b", "f", "2", 10, 20, 2)), path, 0, ORDER, buckets=4)
    assert latest_table.merge_batch(batch(spark, ("a", "f", "late", 5, 20, 3), ("c", "f", "3", 10, 20, 4), ("c", "f", "4", 11, 20, 5)), path, 3, ORDER)
    assert stored(spark, path) == [("a", "f", "1", 0), ("b", "f", "2", 0), ("c", "f", "4", 3)]
    assert not latest_table.merge_batch(batch(spark, ("a", "f", "again", 50, 60, 9)), path, 3, ORDER)
    assert not latest_table.merge_batch(batch(spark, ("a", "f", "older", 50, 60, 9)), path, 1, ORDER)
    assert stored(spark, path)[0] == ("a", "f", "1", 0)
    assert not latest_table.merge_batch(batch(spark).limit(0), path, 3, ORDER)
    assert latest_table.merge_batch(batch(spark).limit(0), path, 4, ORDER)
    assert len(stored(spark, path)) == 3


def test_arrival_order_lets_late_rows_win(spark, tmp_path):
    path, order = str(tmp_path / "t"), ["batch_id", *ORDER]
    latest_table.merge_batch(batch(spark, ("a", "f", "1", 10, 20, 1)), path, 0, order)
    latest_table.merge_batch(batch(spark, ("a", "f", "late", 5, 20, 0)), path, 1, order)
    assert stored(spark, path) == [("a", "f", "late", 1)]


def test_a_crash_before_the_version_leaves_the_old_one(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    first = batch(spark, *[(f"e{i}", "f", "old", 10, 20, i) for i in range(50)])
    second = batch(spark, *[(f"e{i}", "f", "new", 11, 20, i) for i in range(0, 50, 7)])
    latest_table.merge_batch(first, path, 0, ORDER, buckets=8)
    publish = latest_table._publish

    def crash(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(latest_table, "_publish", crash)
    with pytest.raises(RuntimeError):
        latest_table.merge_batch(second, path, 1, ORDER)
    assert {v for _, _, v, _ in stored(spark, path)} == {"old"}
    monkeypatch.setattr(latest_table, "_publish", publish)
    assert latest_table.merge_batch(second, path, 1, ORDER)
    rows = stored(spark, path)
    assert len(rows) == 50 and sum(v == "new" for _, _, v, _ in rows) == 8


def test_only_touched_buckets_are_written_and_files_stay_few(spark, tmp_path):
    path = str(tmp_path / "t")
    latest_table.merge_batch(batch(spark, *[(f"e{i}", "f", "0", 10, 20, i) for i in range(200)]), path, 0, ORDER, buckets=16)
    for n in range(1, 7):
        latest_table.merge_batch(batch(spark, ("e1", "f", str(n), 10 + n, 20, n), ("e2", "f", str(n), 10 + n, 20, n)), path, n, ORDER)
        assert len(list((tmp_path / "t" / "data" / f"batch={n}").glob("bucket=*"))) <= 2
    before = stored(spark, path)
    assert len(latest_table.live_files(spark, path)) <= 16
    assert latest_table.prune(spark, path, keep=2) > 0
    assert stored(spark, path) == before and len(before) == 200
    assert len(list((tmp_path / "t" / "data").rglob("*.parquet"))) <= 18
    assert len(list((tmp_path / "t" / "versions").glob("batch=*"))) == 2
    assert latest_table.prune(spark, path, keep=2) == 0


def test_many_batches_equal_one_fold(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = random_batches(spark, 5)
    for n in range(5):
        latest_table.merge_batch(rows.filter(F.col("batch") == n).drop("batch"), path, n, ORDER, buckets=4)
    expected = freshness.latest_values(rows.drop("batch"), ORDER)
    got = latest_table.read_table(spark, path).drop("batch_id").select(*expected.columns)
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_the_join_of_a_batch_is_made_once(spark, tmp_path):
    path, plans = str(tmp_path / "t"), []

    def index(changes):
        plans.append(changes._jdf.queryExecution().withCachedData().toString())
        assert changes.count() == 1

    latest_table.merge_batch(batch(spark, ("a", "f", "1", 10, 20, 1)), path, 0, ORDER, buckets=2)
    latest_table.merge_batch(batch(spark, ("a", "f", "2", 11, 20, 2)), path, 1, ORDER, on_change=index)
    assert "InMemoryRelation" in plans[0] and "Join FullOuter" not in plans[0].split("InMemoryRelation")[0]
    assert stored(spark, path) == [("a", "f", "2", 1)]


def test_the_incremental_sweep_reads_the_events_once(spark, small, monkeypatch):
    read, calls = queries._events, []
    monkeypatch.setattr(queries, "_events", lambda *args: calls.append(args) or read(*args))
    assert queries.QUERIES["sweep_incremental"](spark, small).count() > 0
    assert len(calls) == 1


@pytest.fixture(scope="module")
def limits(spark):
    rows = [("click", 600, True), ("view", 1200, True), ("off", 5, False)]
    return spark.createDataFrame(rows, "feature_name string, expected_freshness_seconds int, is_active boolean")


@pytest.mark.parametrize("expiring", [False, True])
def test_due_sweeps_equal_full_sweeps(spark, tmp_path, limits, expiring):
    """After each batch and between batches, with values replaced, late, expired and without a time."""
    table, entries, log = (str(tmp_path / name) for name in ("t", "due", "log"))
    rows = random_batches(spark, 4, keys=15, per_batch=50).persist()
    moments = []
    for n in range(4):
        arrived = f"{DAY} 00:{(n + 1) * 12:02d}:00"

        def index(changes, n=n, arrived=arrived):
            for _ in range(2):  # a batch may run again
                due.write_entries(due.due_entries(changes, limits, arrived, expiring), entries, n)

        latest_table.merge_batch(rows.filter(F.col("batch") == n).drop("batch"), table, n, ORDER, buckets=4, on_change=index)
        later = [arrived, f"{DAY} 00:{(n + 1) * 12 + 5:02d}:30"] + ([f"{DAY} 02:00:00"] if n == 3 else [])
        for moment in later:
            sweeps.sweep_due(spark, entries, limits, moment, log)
            checked = freshness.monitored(latest_table.read_table(spark, table), limits, moment, include_expired=not expiring)
            expected = sorted(map(tuple, freshness.sla_sweep(checked).select("feature_name", "sla_seconds", "stale_count", "total_count").collect()))
            logged = spark.read.parquet(log).filter(F.col("swept_at") == F.lit(moment).cast("timestamp"))
            got = sorted(map(tuple, logged.select("feature_name", "sla_seconds", "stale_count", "total_count").collect()))
            assert got == expected, moment
            moments.append(expected)
    assert len(moments) == 9 and any(stale for found in moments for _, _, stale, _ in found)
    sweeps.sweep_due(spark, entries, limits, moment, log)  # run again: the same rows
    again = spark.read.parquet(log).filter(F.col("swept_at") == F.lit(moment).cast("timestamp"))
    assert sorted(map(tuple, again.select("feature_name", "sla_seconds", "stale_count", "total_count").collect())) == expected


def test_a_due_sweep_reads_the_slices_since_the_last_one(spark, tmp_path):
    rows = spark.createDataFrame([("click", m * 60_000_000, 1, 0) for m in range(100)], "feature_name string, at long, total long, stale long")
    path = str(tmp_path / "due")
    due.write_entries(rows, path, 0)
    found = due.entries_between(spark, path, "1970-01-01 00:30:00", "1970-01-01 00:35:30")
    assert sorted(r["at"] // 60_000_000 for r in found.collect()) == [31, 32, 33, 34, 35]
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert filters.count("slice") >= 2
