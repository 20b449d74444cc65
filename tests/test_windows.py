from __future__ import annotations

import math
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from freshet.operators import windows

BASE = 1_700_000_000


def events(spark, rows):
    """rows: (seconds, user, amount)"""
    return spark.createDataFrame(
        [(int(round(t * 1_000_000)), u, a) for t, u, a in rows], "us bigint, user_id string, amount double"
    ).select(F.timestamp_micros("us").alias("ts"), "user_id", "amount")


def seconds(moment: datetime) -> float:
    return moment.replace(tzinfo=timezone.utc).timestamp() if moment.tzinfo is None else moment.timestamp()


def as_dicts(df):
    rows = []
    for r in df.collect():
        d = r.asDict()
        d["window_start"], d["window_end"] = seconds(d["window_start"]), seconds(d["window_end"])
        rows.append(d)
    return sorted(rows, key=lambda d: (d.get("window_type", ""), d["window_start"]))


def stats(members):
    amounts = [a for _, _, a in members]
    total = sum(round(a * 100) for a in amounts)
    n = len(amounts)
    return {
        "count": n,
        "total_amount": total / 100,
        "avg_amount": math.floor((2 * total + n) / (2 * n)) / 100 if n else 0.0,
        "min_amount": min(amounts, default=0.0),
        "max_amount": max(amounts, default=0.0),
        "unique_users": len({u for _, u, _ in members}),
    }


def brute_series(rows, window, step, empty=True):
    first, last = min(r[0] for r in rows), max(r[0] for r in rows)
    start, out = math.ceil(first / step) * step, []
    while start + window <= last + step:
        members = [r for r in rows if start <= r[0] <= start + window]
        if members or empty:
            out.append({"window_start": start, "window_end": start + window, **stats(members)})
        start += step
    return out


def brute_tumbling(rows, size):
    starts = sorted({math.floor(t / size) * size for t, _, _ in rows})
    return [
        {"window_start": s, "window_end": s + size, **stats([r for r in rows if s <= r[0] < s + size])} for s in starts
    ]


def test_right_edge_opens_a_new_window(spark):
    got = as_dicts(windows.tumbling(events(spark, [(59.9, "a", 1.0), (60.0, "a", 2.0)]), 60))
    assert [(d["window_start"], d["count"]) for d in got] == [(0, 1), (60, 1)]


def test_before_the_epoch(spark):
    got = as_dicts(windows.tumbling(events(spark, [(-0.5, "a", 1.0), (0.0, "a", 1.0)]), 60))
    assert [d["window_start"] for d in got] == [-60, 0]


def test_one_hour_of_events_is_one_window(spark):
    rows = [(BASE - BASE % 3600 + 30 * i, f"u{i % 5}", 1.5) for i in range(100)]
    (got,) = as_dicts(windows.tumbling(events(spark, rows), 3600))
    assert (got["count"], got["unique_users"], got["total_amount"]) == (100, 5, 150.0)


def test_point_query_includes_both_ends(spark):
    e = events(spark, [(900, "a", 99.0), (970, "b", 2.0), (1000, "a", 1.0), (1030, "a", 4.0), (1030.5, "a", 8.0)])
    got = as_dicts(windows.sliding_at(e, "1970-01-01 00:17:10", 60))[0]
    assert (got["window_start"], got["window_end"], got["count"], got["total_amount"]) == (970, 1030, 3, 7.0)


def test_point_query_on_nothing_shows_zeros(spark):
    got = as_dicts(windows.sliding_at(events(spark, [(900, "a", 99.0)]), "1980-01-01 00:00:00", 60))[0]
    assert {k: got[k] for k in windows.STATISTICS} == stats([])


def test_point_query_at_the_newest_event(spark):
    e = events(spark, [(900, "a", 99.0), (1000, "a", 1.0), (1030, "b", 3.0)])
    got = as_dicts(windows.sliding_at_latest(e, 60))[0]
    assert (got["window_start"], got["window_end"], got["count"], got["unique_users"]) == (970, 1030, 2, 2)


def test_mean_is_rounded_half_up(spark):
    got = as_dicts(windows.tumbling(events(spark, [(1, "a", 0.01), (2, "a", 0.02)]), 60))
    assert got[0]["avg_amount"] == 0.02  # 0.015


ROWS = st.lists(
    st.tuples(
        st.integers(0, 2_000).map(lambda q: BASE + q / 2),
        st.sampled_from("abc"),
        st.integers(0, 50_000).map(lambda c: c / 100),
    ),
    min_size=1,
    max_size=30,
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS, shape=st.sampled_from([(300, 60), (60, 60), (100, 70), (30, 60)]))
def test_sliding_series_equals_brute_force(spark, rows, shape):
    window, step = shape
    e = events(spark, rows)
    assert as_dicts(windows.sliding_series(e, window, step)) == brute_series(rows, window, step)
    assert as_dicts(windows.sliding_series(e, window, step, include_empty=False)) == brute_series(
        rows, window, step, empty=False
    )


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=ROWS)
@example(rows=[(BASE, "a", 0.0), (BASE + 340.5, "a", 0.0)])  # a window between them that neither is in
def test_multi_resolution_equals_brute_force(spark, rows):
    got = as_dicts(windows.multi_resolution(events(spark, rows)))
    for name, size in windows.TUMBLING_SECONDS.items():
        part = [{k: v for k, v in d.items() if k != "window_type"} for d in got if d["window_type"] == name]
        assert part == brute_tumbling(rows, size)
        assert sum(d["count"] for d in part) == len(rows)
    part = [{k: v for k, v in d.items() if k != "window_type"} for d in got if d["window_type"] == "sliding"]
    assert part == brute_series(rows, 300, 60)


def test_tail_is_what_a_bounded_buffer_keeps(spark):
    rows = [(BASE + 37 * i, f"u{i % 3}", 1.0) for i in range(60)]
    kept = [r for r in rows if r[0] >= rows[-1][0] - 360]
    assert as_dicts(windows.sliding_series(events(spark, rows), tail_seconds=360)) == brute_series(kept, 300, 60)


def test_window_end_follows_the_type_of_the_input(spark):
    e = events(spark, [(1, "a", 1.0)])
    plain = e.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    assert dict(windows.sliding_series(plain).dtypes)["window_end"] == "timestamp_ntz"
    assert dict(windows.tumbling(e, 60).dtypes)["window_end"] == "timestamp"
    (row,) = windows.tumbling(plain, 60).collect()
    assert row.window_end - row.window_start == timedelta(seconds=60)


def test_no_events_give_no_windows(spark):
    e = events(spark, [(1, "a", 1.0)]).filter("user_id = 'x'")
    assert windows.sliding_series(e).isEmpty() and windows.tumbling(e, 60).isEmpty()


@pytest.mark.parametrize("n", [50, 500])
def test_no_event_is_lost(spark, n):
    rows = [(BASE + (i * 7919) % 5000, f"u{i % 11}", (i % 97) / 4) for i in range(n)]
    assert sum(d["count"] for d in as_dicts(windows.tumbling(events(spark, rows), 60))) == n
