"""Profiles from stored moments equal profiles of the rows."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from freshet.operators import moments, snapshots
from freshet.sources.tables import read_table


def by_column(df):
    return {r["column_name"]: r for r in df.collect()}


def test_merged_doubles_are_those_of_the_rows(spark, small):
    events = read_table(spark, small, "events").withColumn("value", F.when(F.col("event_id") % 7 > 0, F.col("value") + 1e6))
    groups = events.withColumn("part", F.pmod(F.xxhash64("event_id"), F.lit(13)))
    got = by_column(moments.merged_profile(moments.moments(groups, ["part"], columns=["value", "event_id"])))
    expected = by_column(snapshots.profile(events, columns=["value", "event_id"]))
    for name, row in expected.items():
        assert got[name]["row_count"] == row["row_count"]
        for c in ("mean", "std", "min", "max"):
            assert math.isclose(got[name][c], row[c], rel_tol=1e-12), (name, c)


def test_sets_of_snapshots(spark, small, tmp_path):
    events = read_table(spark, small, "events")
    path = str(tmp_path / "m")
    days = events.withColumn("d", F.date_format("ts", "yyyyMMdd"))
    names = ["20240101", "20240102", "20240103"]
    for name in [*names, names[0]]:  # one is written twice
        moments.write_moments(days.filter(F.col("d") == name).drop("d"), path, name, scale=2)
    some = moments.read_moments(spark, path, names[1:])
    rows = days.filter(F.col("d").isin(names[1:])).drop("d")
    assert by_column(moments.merged_profile(some, 2)) == by_column(snapshots.profile(rows, scale=2).select("column_name", "row_count", "mean", "std", "min", "max"))
    a, b = (moments.merged_profile(moments.read_moments(spark, path, [n]), 2) for n in names[:2])
    plain = [snapshots.profile(days.filter(F.col("d") == n).drop("d"), scale=2) for n in names[:2]]
    assert sorted(map(tuple, snapshots.profile_diff(a, b).collect())) == sorted(map(tuple, snapshots.profile_diff(*plain).collect()))
    drift = moments.merged_drift(moments.read_moments(spark, path), "value", scale=2)
    expected = snapshots.drift_series(days.filter(F.col("d").isin(names)), "d", "value", scale=2)
    assert sorted(map(tuple, drift.collect())) == sorted(map(tuple, expected.collect()))
    assert all("/m/" in f for f in drift.inputFiles()) and len(drift.inputFiles()) <= 3


def test_empty_groups_and_columns(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (1, None), (2, 3.0), (2, 5.0)], "g int, x double")
    got = by_column(moments.merged_profile(moments.moments(rows, ["g"])))["x"]
    assert (got["row_count"], got["mean"], got["std"], got["min"], got["max"]) == (4, 4.0, math.sqrt(2), 3.0, 5.0)
    none = by_column(moments.merged_profile(moments.moments(rows.filter("g = 1"), ["g"], scale=2), 2))["x"]
    assert (none["row_count"], none["mean"], none["std"], none["min"], none["max"]) == (2, 0.0, 0.0, 0.0, 0.0)
    with pytest.raises(ValueError):
        moments.moments(rows.select(F.lit("a").alias("t")))
