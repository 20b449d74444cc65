"""The table of live folders: expiry in two phases, readers of earlier versions."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from freshet.plans.queries import QUERIES
from freshet.sources import manifest, sinks
from freshet.sources.tables import file_states

AS_OF = "2024-01-03 12:30:00"
DAY = 86_400


def lake(spark, folder, hours):
    rows = spark.createDataFrame([(i, h) for i, h in enumerate(hours)], "id int, hour int")
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    sinks.write_raw_events(rows.select("id", (start + F.make_dt_interval(hours="hour")).alias("ts")), folder, "ts")


def ids(rows):
    return sorted(r["id"] for r in rows.collect())


def test_expiry_in_two_phases(spark, tmp_path):
    raw, live = f"{tmp_path}/raw", f"{tmp_path}/live"
    lake(spark, raw, range(72))
    first = manifest.register(spark, raw, live)
    before = manifest.read_live(spark, raw, live)
    second = manifest.expire(spark, live, AS_OF, DAY)
    assert second == first + 1
    # the border is 12:30 of the second day: the folder of 12 o'clock stays, its row at 12:00 is too old
    assert ids(manifest.read_live(spark, raw, live)) == list(range(36, 72))
    assert ids(manifest.read_retained(spark, raw, live, "ts", AS_OF, DAY)) == list(range(37, 72))
    # readers of the earlier version still find all, and versions kept are not touched
    assert ids(before) == list(range(72)) and manifest.remove_dead(spark, raw, live, keep=2) == 0
    assert ids(manifest.read_live(spark, raw, live, first)) == list(range(72))
    # data written but not yet registered stays unseen and is not removed
    lake(spark, raw, [100])
    assert manifest.remove_dead(spark, raw, live, keep=1) == 36
    assert manifest.remove_dead(spark, raw, live, keep=1) == 0
    assert ids(manifest.read_live(spark, raw, live)) == list(range(36, 72))
    manifest.register(spark, raw, live)
    assert ids(manifest.read_live(spark, raw, live)) == sorted([0, *range(36, 72)])


def test_readers_open_live_folders_only(spark, tmp_path):
    raw, live = f"{tmp_path}/raw", f"{tmp_path}/live"
    lake(spark, raw, range(48))
    manifest.register(spark, raw, live)
    manifest.expire(spark, live, "2024-01-02 23:00:00", 3 * 3600)
    assert len(manifest.read_live(spark, raw, live).inputFiles()) == 4


def test_everything_expired_and_no_version(spark, tmp_path):
    raw, live = f"{tmp_path}/raw", f"{tmp_path}/live"
    lake(spark, raw, [0, 1])
    assert manifest.live_folders(spark, live).count() == 0
    with pytest.raises(ValueError):
        manifest.expire(spark, live, AS_OF, DAY)
    manifest.register(spark, raw, live)
    manifest.expire(spark, live, "2024-03-01 00:00:00", DAY)
    rows = manifest.read_live(spark, raw, live)
    assert rows.columns == ["id", "ts", "year", "month", "day", "hour"] and rows.count() == 0


def test_lookups_see_a_table_overwritten_in_place(spark, small, tmp_path):
    file = tmp_path / "events.parquet"
    shutil.copy(f"{small}/events.parquet", file)
    one = file_states(spark.read.parquet(str(file)))
    count = QUERIES["feature_row_count"](spark, str(tmp_path)).first()["row_count"]
    half = spark.read.parquet(f"{small}/events.parquet").filter("event_id % 2 = 0").toPandas()
    half.to_parquet(file, coerce_timestamps="us", index=False)
    (tmp_path / ".events.parquet.crc").unlink(missing_ok=True)
    spark.catalog.refreshByPath(str(file))
    assert file_states(spark.read.parquet(str(file))) != one
    now = QUERIES["feature_row_count"](spark, str(tmp_path)).first()["row_count"]
    assert now == len(half) < count
