"""Windows asked for at many moments, against one window at a time; progress; order."""

from __future__ import annotations

import math
import time
from datetime import timezone

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from freshet.operators import probes, windows
from freshet.plans.queries import _definitions, _message_stream
from freshet.sources.tables import read_table, window_events
from freshet.streaming import ingest, inputs, progress

BASE = 1_700_000_000


def frame(spark, rows):
    made = [(None if t is None else round(t * 1_000_000), u, a) for t, u, a in rows]
    return spark.createDataFrame(made, "us bigint, user_id string, amount double").select(F.timestamp_micros("us").alias("ts"), "user_id", "amount")


def asked(spark, moments):
    made = [(i, None if t is None else round(t * 1_000_000)) for i, t in enumerate(moments)]
    return spark.createDataFrame(made, "id int, us bigint").select("id", F.timestamp_micros("us").alias("at"))


def plain(rows, at, window):
    members = [r for r in rows if at is not None and r[0] is not None and at - window <= r[0] <= at]
    amounts = [a for _, _, a in members if a is not None]
    total, n = sum(round(a * 100) for a in amounts), len(amounts)
    mean = math.floor((2 * total + n) / (2 * n)) / 100 if n else 0.0
    return (len(members), total / 100, mean, min(amounts, default=0.0), max(amounts, default=0.0), len({u for _, u, _ in members if u is not None}))


MOMENTS = st.integers(0, 120).map(lambda q: BASE + q / 2)
EVENTS = st.lists(st.tuples(st.none() | MOMENTS, st.none() | st.sampled_from("abc"), st.none() | st.integers(0, 500).map(lambda c: c / 100)), max_size=25)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=EVENTS, moments=st.lists(st.none() | MOMENTS, min_size=1, max_size=12), window=st.sampled_from([1, 4, 30]))
def test_probes_equal_one_window_at_a_time(spark, rows, moments, window):
    found = probes.sliding_probes(frame(spark, rows), asked(spark, moments), window).collect()
    assert len(found) == len(moments)
    for r in found:
        at = moments[r["id"]]
        assert tuple(r[c] for c in windows.STATISTICS) == plain(rows, at, window)
        if at is None:
            assert r["window_end"] is None and r["window_start"] is None
        else:
            ends = [r[c].replace(tzinfo=timezone.utc).timestamp() if r[c].tzinfo is None else r[c].timestamp() for c in ("window_start", "window_end")]
            assert ends == pytest.approx([at - window, at])


def test_probes_equal_the_point_query(spark, small):
    events = window_events(read_table(spark, small, "events"))
    moments = ["2024-01-15 12:00:00", "2024-01-03 00:00:00", "2023-01-01 00:00:00"]
    table = spark.createDataFrame([(m,) for m in moments], "m string").select("m", F.col("m").cast("timestamp_ntz").alias("at"))
    found = {r["m"]: r for r in probes.sliding_probes(events, table, 7200).collect()}
    for m in moments:
        one = windows.sliding_at(events, m, 7200).first()
        assert all(found[m][c] == one[c] for c in one.asDict())


def test_probes_need_exact_sums(spark):
    with pytest.raises(ValueError, match="scale"):
        probes.sliding_probes(frame(spark, []), asked(spark, [1.0]), 60, scale=None)


def test_no_range_join_and_no_spread(spark, small):
    events = window_events(read_table(spark, small, "events"))
    plan = probes.sliding_probes(events, events.select(F.col("ts").alias("at")), 86_400)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_windows_in_order_are_dealt_by_range(spark, small):
    found = windows.in_order(windows.tumbling(window_events(read_table(spark, small, "events")), 3600))
    assert "rangepartitioning(window_start" in found._jdf.queryExecution().executedPlan().toString()
    starts = [r["window_start"] for r in found.collect()]
    assert starts == sorted(starts) and len(starts) > 100


def test_progress_can_be_read_after_the_query(spark, small, tmp_path):
    """Several batches; a report that comes twice counts once."""
    events = read_table(spark, small, "events")
    for i in range(3):
        events.filter(F.col("event_id") % 3 == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.05)
    log = progress.ProgressLog(spark, str(tmp_path / "log"), ["messages"])
    spark.streams.addListener(log)
    try:
        messages = _message_stream(inputs.read_parquet_stream(spark, str(tmp_path / "in"), max_files=1))
        query = ingest.start_ingest(
            messages, _definitions(spark), str(tmp_path / "latest"), str(tmp_path / "dead"), str(tmp_path / "c"), ["event_ts", "offset"], buckets=4
        )
        assert query.awaitTermination(180)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    counts = {r["metric"]: r for r in progress.current_counts(spark, str(tmp_path / "log")).collect()}
    assert counts["processed"]["value"] + counts["failed"]["value"] == events.count()
    assert counts["failed"]["value"] == spark.read.parquet(str(tmp_path / "dead")).count()
    assert counts["processed"]["last_batch"] == 2 and counts["processed"]["last_run"] is not None
    spark.read.parquet(str(tmp_path / "log")).limit(1).write.mode("append").parquet(str(tmp_path / "log"))
    again = {r["metric"]: r["value"] for r in progress.current_counts(spark, str(tmp_path / "log")).collect()}
    assert again == {m: r["value"] for m, r in counts.items()}
