from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from freshet.operators import snapshots

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture
def log_path(tmp_path):
    return str(tmp_path / "log")


def commit(spark, log_path, name, minute, data="/no/such/path"):
    return snapshots.commit_snapshot(
        spark, data, log_path, label=name, snapshot_id=name, at=T0 + timedelta(minutes=minute), on_missing="empty"
    )


def states(spark, log_path):
    return {r.snapshot_id: r for r in snapshots.snapshot_states(snapshots.read_log(spark, log_path)).collect()}


def test_nothing_committed_yet(spark, log_path):
    log = snapshots.read_log(spark, log_path)
    assert log.isEmpty() and snapshots.current_snapshot(log).isEmpty() and snapshots.list_snapshots(log).isEmpty()


def test_commit_rollback_commit(spark, log_path):
    for i, name in enumerate("abc"):
        commit(spark, log_path, name, i)
    got = states(spark, log_path)
    assert [n for n, r in got.items() if r.is_current] == ["c"]
    assert {n: r.parent_snapshot_id for n, r in got.items()} == {"a": None, "b": "a", "c": "b"}
    assert (got["a"].row_count, got["a"].stats) == (0, {})

    snapshots.rollback_snapshot(spark, log_path, "a", T0 + timedelta(minutes=5))
    got = states(spark, log_path)
    assert len(got) == 3 and got["a"].status == "current" and got["c"].status == "archived"

    commit(spark, log_path, "d", 6)
    log = snapshots.read_log(spark, log_path)
    assert states(spark, log_path)["d"].parent_snapshot_id == "a"
    assert [r.snapshot_id for r in snapshots.list_snapshots(log).collect()] == ["d", "c", "b", "a"]
    assert [(r.snapshot_id, r.depth) for r in snapshots.lineage(log).orderBy("depth").collect()] == [("d", 0), ("a", 1)]
    chain = snapshots.lineage(log, "c").orderBy("depth").collect()
    assert [r.snapshot_id for r in chain] == ["c", "b", "a"]


def test_rollback_to_unknown(spark, log_path):
    commit(spark, log_path, "a", 0)
    with pytest.raises(ValueError, match="no commit has the id"):
        snapshots.rollback_snapshot(spark, log_path, "zzz")


def test_missing_data_raises_by_default(spark, log_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        snapshots.commit_snapshot(spark, "/no/such/path", log_path)


def test_profile_diff_of_two_commits(spark, tmp_path, log_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.createDataFrame([(1.0, 5, "x"), (3.0, 5, "y")], "amount double, n int, name string").write.parquet(a)
    spark.createDataFrame([(4.0, "x")], "amount double, name string").write.parquet(b)
    commit(spark, log_path, "a", 0, a)
    commit(spark, log_path, "b", 1, b)
    header, stats = snapshots.snapshot_diff(snapshots.read_log(spark, log_path), "a", "b")
    head = header.first()
    assert (head.schema_changed, head.row_count_a, head.row_count_b, head.row_count_delta) == (True, 2, 1, -1)
    got = {r.feature: r for r in stats.collect()}
    assert set(got) == {"amount", "n"}
    assert (got["amount"].mean_a, got["amount"].mean_b, got["amount"].mean_delta) == (2.0, 4.0, 2.0)
    assert (got["amount"].std_a, got["amount"].std_b) == (pytest.approx(2**0.5), 0.0)
    assert (got["n"].mean_b, got["n"].mean_delta, got["n"].max_delta) == (0.0, -5.0, -5.0)


def test_a_snapshot_keeps_its_rows(spark, tmp_path, log_path):
    data = str(tmp_path / "data")
    for minute, name in enumerate("ab"):
        spark.range(3 * minute + 2).write.mode("overwrite").parquet(data)
        commit(spark, log_path, name, minute, data)
    assert snapshots.read_snapshot(spark, log_path).count() == 5
    snapshots.rollback_snapshot(spark, log_path, "a", T0 + timedelta(minutes=5))
    assert snapshots.read_snapshot(spark, log_path).count() == 2
    assert snapshots.read_snapshot(spark, log_path, "b").count() == 5
    with pytest.raises(ValueError, match="no commit has the id"):
        snapshots.read_snapshot(spark, log_path, "zzz")
    with pytest.raises(ValueError, match="no commit has the id"):
        snapshots.snapshot_diff(snapshots.read_log(spark, log_path), "a", "zzz")
    with pytest.raises(ValueError, match="is taken"):
        commit(spark, log_path, "a", 9, data)


def test_moments_are_ordered_across_zones(spark, log_path):
    commit(spark, log_path, "a", 0)
    east = timezone(timedelta(hours=9))
    snapshots.commit_snapshot(spark, "/no", log_path, snapshot_id="b", at=datetime(2024, 1, 1, 9, 1, tzinfo=east), on_missing="empty")
    snapshots.commit_snapshot(spark, "/no", log_path, snapshot_id="c", at=datetime(2024, 1, 1, 0, 2), on_missing="empty")
    assert {n: r.parent_snapshot_id for n, r in states(spark, log_path).items()} == {"a": None, "b": "a", "c": "b"}


def test_schema_hash(spark):
    def h(ddl):
        return snapshots.schema_hash(spark.createDataFrame([], ddl))

    assert h("a string, b double") == h("b double, a string")
    assert h("a string, b double") != h("a string, b float")
    assert len(h("a string")) == 16


def test_profile_skips_text_and_partition_date(spark):
    df = spark.range(3).select("id", F.lit("x").alias("t"), F.lit(1).alias("event_date"), F.lit(None).cast("double").alias("empty"))
    got = {r.column_name: r for r in snapshots.profile(df).collect()}
    assert set(got) == {"id", "empty"}
    assert (got["id"].row_count, got["id"].mean, got["id"].std, got["id"].min, got["id"].max) == (3, 1.0, 1.0, 0.0, 2.0)
    assert (got["empty"].mean, got["empty"].std) == (0.0, 0.0)
    assert snapshots.profile(df.select("t")).isEmpty()


def test_ids_are_ordered_in_time():
    a, b = (snapshots.new_snapshot_id(T0 + timedelta(seconds=s)) for s in (0, 1))
    assert a < b and len(a) == len(b)


def test_drift_series(spark):
    rows = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "s string, x double")
    got = [(r.s, r["mean"], r.mean_delta) for r in snapshots.drift_series(rows, "s", "x").orderBy("s").collect()]
    assert got == [("a", 2.0, None), ("b", 5.0, 3.0)]
