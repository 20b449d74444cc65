"""Streams over several files: the result is that of the batch operator."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from freshet.operators import freshness, windows
from freshet.plans.queries import _definitions, _message_stream
from freshet.functions import messages as msg
from freshet.sources.tables import read_table, window_events
from freshet.streaming import ingest, inputs, lake, sweeps
from freshet.streaming import windows as sw


def finish(query):
    assert query.awaitTermination(180), "stream did not stop"


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    b = b.select(*a.columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture(scope="module")
def parts(spark, small, tmp_path_factory):
    """The events in four folders of arrival; late ones come last."""
    root = tmp_path_factory.mktemp("arrivals")
    events = read_table(spark, small, "events")
    for i in range(4):
        events.filter(F.col("event_id") % 4 == i).coalesce(1).write.mode("append").parquet(str(root / "events"))
        time.sleep(0.05)
    return str(root / "events")


def test_tumbling_over_several_batches(spark, small, parts, tmp_path):
    def run():
        events = window_events(inputs.read_parquet_stream(spark, parts, max_files=1))
        finish(sw.start_tumbling(events, 3600, str(tmp_path / "w"), str(tmp_path / "c")))

    run()
    expected = windows.tumbling(window_events(read_table(spark, small, "events")), 3600)
    assert spark.read.parquet(str(tmp_path / "w")).select("batch_id").distinct().count() == 4
    same(sw.read_tumbling(spark, str(tmp_path / "w")), expected)
    run()  # nothing new: nothing changes
    same(sw.read_tumbling(spark, str(tmp_path / "w")), expected)


def test_all_resolutions_over_several_batches(spark, small, parts, tmp_path):
    events = window_events(inputs.read_parquet_stream(spark, parts, max_files=1))
    finish(sw.start_multi_resolution(events, str(tmp_path / "p"), str(tmp_path / "c")))
    expected = windows.multi_resolution(window_events(read_table(spark, small, "events")))
    same(sw.read_multi_resolution(spark, str(tmp_path / "p"), like="timestamp_ntz"), expected)


def test_sliding_over_several_batches(spark, small, parts, tmp_path):
    events = window_events(inputs.read_parquet_stream(spark, parts, max_files=1))
    finish(sw.start_sliding(events, str(tmp_path / "s"), str(tmp_path / "c"), 600, 60))
    batch = window_events(read_table(spark, small, "events"))
    expected = windows.finish_sliding(windows.sliding_class_partials(batch, 600, 60), 600, 60, "timestamp_ntz")
    same(sw.read_sliding(spark, str(tmp_path / "s"), 600, 60, like="timestamp_ntz"), expected)


def by_time(spark, small, root, parts=8):
    """The events in files of consecutive times, each in its own batch."""
    events = read_table(spark, small, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    bounds = [r[0] for r in events.selectExpr(f"explode(percentile_approx(unix_micros(ts), array({','.join(str((i + 1) / parts) for i in range(parts))})))").collect()]
    before = -1
    for bound in bounds:
        t = F.unix_micros("ts")
        events.filter((t > before) & (t <= bound)).coalesce(1).write.mode("append").parquet(root)
        before = bound
        time.sleep(1.1)  # files are read in the order of their times
    return inputs.read_parquet_stream(spark, root, max_files=1), events


def test_state_of_sealed_panes_does_not_grow(spark, small, tmp_path):
    stream, events = by_time(spark, small, str(tmp_path / "in"))
    multi = sw.start_multi_resolution(window_events(stream), str(tmp_path / "p"), str(tmp_path / "c"), delay="6 minutes")
    finish(multi)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in multi.recentProgress]
    read = [p["numInputRows"] for p in multi.recentProgress if p["numInputRows"]]
    assert len(read) == 8 and sum(read) == events.count()
    # What is open after a batch is its own input at most, then what lies within the delay.
    assert max(held) <= max(read) + 10 and held[-1] < 10
    got = sw.read_multi_resolution(spark, str(tmp_path / "p"), checkpoint=str(tmp_path / "c"))
    same(got, windows.multi_resolution(window_events(events)))
    panes = spark.read.parquet(str(tmp_path / "p"))
    assert panes.count() == panes.dropDuplicates(sw.PANE_KEY).count()
    sliding = sw.start_sliding(window_events(stream), str(tmp_path / "s"), str(tmp_path / "d"), 600, 60, delay="11 minutes")
    finish(sliding)
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in sliding.recentProgress) <= max(read) + 10
    batch = window_events(events)
    expected = windows.finish_sliding(windows.sliding_class_partials(batch, 600, 60), 600, 60, "timestamp")
    same(sw.read_sliding(spark, str(tmp_path / "s"), 600, 60, checkpoint=str(tmp_path / "d")), expected)


def test_latest_state_is_read_as_of_a_batch(spark, small, tmp_path):
    from freshet.streaming import state

    stream, events = by_time(spark, small, str(tmp_path / "in"), parts=3)
    order = ["ts", "event_id"]
    key = ["user_id", "event_type"]
    finish(state.start_latest_state(stream, order, str(tmp_path / "c"), key))
    same(state.read_latest_state(spark, str(tmp_path / "c"), events, order, key), freshness.latest_values(events, order, key))
    assert state.finished_batch(spark, str(tmp_path / "c")) == 2
    first = state.read_latest_state(spark, str(tmp_path / "c"), events, order, key, batch_id=0)
    bound = first.agg(F.max("ts")).first()[0]
    same(first, freshness.latest_values(events.filter(F.col("ts") <= F.lit(bound)), order, key))


def test_closed_windows_come_once_after_the_watermark(spark, small, tmp_path):
    source = str(tmp_path / "in")
    events = read_table(spark, small, "events")
    for piece in ("ts < '2024-01-15'", "ts >= '2024-01-15'"):
        events.filter(piece).coalesce(1).write.mode("append").parquet(source)
        time.sleep(1.1)  # files are read in the order of their times
    stream = inputs.read_parquet_stream(spark, source, max_files=1).withColumn("ts", F.col("ts").cast("timestamp"))
    closed = sw.closed_tumbling(window_events(stream), 3600, "1 minute")
    writer = closed.writeStream.format("parquet").option("path", str(tmp_path / "out"))
    finish(writer.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    got = spark.read.parquet(str(tmp_path / "out"))
    newest = events.agg(F.max("ts")).first()[0]
    whole = windows.tumbling(window_events(events.withColumn("ts", F.col("ts").cast("timestamp"))), 3600)
    same(got, whole.filter(F.col("window_end") <= F.lit(newest).cast("timestamp") - F.expr("INTERVAL 1 MINUTE")))


@pytest.fixture(scope="module")
def ingested(spark, small, parts, tmp_path_factory):
    out = tmp_path_factory.mktemp("ingest")
    messages = _message_stream(inputs.read_parquet_stream(spark, parts, max_files=1))
    query = ingest.start_ingest(
        messages, _definitions(spark), str(out / "latest"), str(out / "dead"), str(out / "c"), ["event_ts", "offset"]
    )
    finish(query)
    return out, query


def parsed(spark, small):
    return msg.parse_messages(_message_stream(read_table(spark, small, "events")), received_at="received_at")


def test_ingest_keeps_the_newest_value_of_each_key(spark, small, ingested):
    out, _ = ingested
    events = msg.valid_events(parsed(spark, small))
    expected = freshness.latest_values(events, ["event_ts", "offset"])
    columns = ["entity_id", "feature_name", "value_raw", "value_type", "event_ts", "offset"]
    got = ingest.read_latest(spark, str(out / "latest"), ["event_ts", "offset"])
    same(got.select(*columns), expected.select(*columns))
    wrong = got.filter(F.unix_micros("expires_at") != F.unix_micros("written_at") + F.col("ttl_seconds") * 1_000_000)
    assert wrong.isEmpty()


def test_every_message_is_kept_or_dead(spark, small, ingested):
    out, query = ingested
    dead = spark.read.parquet(str(out / "dead"))
    expected = msg.dead_letters(parsed(spark, small))
    same(dead.select("offset", "error", "raw_value"), expected.select("offset", "error", "raw_value"))
    counts = freshness.processing_counts(parsed(spark, small)).first()
    assert counts.messages_processed + counts.messages_failed == read_table(spark, small, "events").count()
    assert counts.messages_failed == dead.count() > 0


def test_progress_reports_the_counts(spark, small, ingested):
    _, query = ingested
    metrics = [p["observedMetrics"]["messages"] for p in query.recentProgress if "messages" in p["observedMetrics"]]
    counts = freshness.processing_counts(parsed(spark, small)).first()
    assert sum(m["processed"] for m in metrics) == counts.messages_processed
    assert sum(m["failed"] for m in metrics) == counts.messages_failed


def test_arrival_order_lets_late_events_win(spark, small, ingested):
    out, _ = ingested
    got = ingest.read_latest(spark, str(out / "latest"), ["batch_id", "event_ts", "offset"])
    expected = freshness.latest_values(
        spark.read.parquet(str(out / "latest")), ["batch_id"]
    )
    same(got, expected)
    assert got.filter("batch_id = 3").count() > 0


def test_compaction_changes_nothing(spark, ingested, tmp_path):
    out, _ = ingested
    order = ["event_ts", "offset"]
    ingest.compact_latest(spark, str(out / "latest"), str(tmp_path / "folded"), order)
    same(ingest.read_latest(spark, str(tmp_path / "folded"), order), ingest.read_latest(spark, str(out / "latest"), order))


def test_a_batch_that_runs_again_leaves_no_repeats(spark, small, tmp_path):
    from freshet.streaming.batches import write_batch

    rows = read_table(spark, small, "events").limit(10)
    for batch_id in (0, 1, 1):
        write_batch(rows, str(tmp_path / "t"), batch_id)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 20


def test_repeats_are_dropped_across_batches(spark, small, tmp_path):
    events = read_table(spark, small, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    for _ in range(2):
        events.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = inputs.read_parquet_stream(spark, str(tmp_path / "in"), max_files=1)
    once = inputs.deduplicated(stream, ["event_id"], "ts", "60 days")
    writer = once.writeStream.format("parquet").option("path", str(tmp_path / "out"))
    finish(writer.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    same(spark.read.parquet(str(tmp_path / "out")), events)


def test_lake_folders(spark, small, parts, tmp_path):
    stream = inputs.read_parquet_stream(spark, parts)
    finish(lake.start_raw_events(stream, str(tmp_path / "raw"), str(tmp_path / "c"), "ts", interval=None))
    rows = spark.read.parquet(str(tmp_path / "raw"))
    assert rows.count() == read_table(spark, small, "events").count()
    assert rows.filter("hour <> hour(ts) OR day <> day(ts) OR month <> month(ts) OR year <> year(ts)").isEmpty()
    hour = tmp_path / "raw" / "year=2024" / "month=01" / "day=02" / "hour=05"
    assert hour.is_dir() and len(list(hour.rglob("*.parquet"))) == 1


def test_feature_updates_and_audit(spark, small, parts, tmp_path):
    stream = inputs.read_parquet_stream(spark, parts).withColumn("entity_type", F.lit("customer"))
    finish(lake.start_feature_updates(stream, str(tmp_path / "u"), str(tmp_path / "c1"), "ts", interval=None))
    assert (tmp_path / "u" / "entity_type=customer" / "year=2024" / "month=01" / "day=02").is_dir()
    finish(ingest.start_audit(inputs.read_parquet_stream(spark, parts), str(tmp_path / "a"), str(tmp_path / "c2")))
    assert spark.read.parquet(str(tmp_path / "a")).count() == read_table(spark, small, "events").count()


def test_message_files_as_a_stream(spark, small, tmp_path):
    from freshet.sources.sinks import write_messages

    events = msg.valid_events(parsed(spark, small)).drop("value")
    write_messages(msg.to_messages(events), str(tmp_path / "in"))
    stream = inputs.read_message_files(spark, str(tmp_path / "in"))
    query = ingest.start_ingest(
        stream, _definitions(spark), str(tmp_path / "latest"), str(tmp_path / "dead"), str(tmp_path / "c"), ["event_ts"]
    )
    finish(query)
    got = ingest.read_latest(spark, str(tmp_path / "latest"), ["event_ts"])
    expected = freshness.latest_values(events, ["event_ts"])
    columns = ["entity_id", "feature_name", "value_raw", "value_type", "event_ts"]
    same(got.select(*columns), expected.select(*columns))


def test_sweeps_by_trigger(spark, tmp_path):
    rows = [("a", "click", "1", "float"), ("b", "click", "1", "float")]
    latest = spark.createDataFrame(rows, "entity_id string, feature_name string, value_raw string, value_type string")
    latest = latest.withColumn("event_ts", F.when(F.col("entity_id") == "a", F.lit("2000-01-01").cast("timestamp")).otherwise(F.lit("2100-01-01").cast("timestamp")))
    latest = latest.withColumn("expires_at", F.lit("2100-01-01").cast("timestamp"))
    definitions = _definitions(spark)
    query = sweeps.start_sweeps(
        spark, lambda: latest, lambda: definitions, str(tmp_path / "log"), str(tmp_path / "c"), "1 second"
    )
    deadline = time.time() + 60
    try:
        while time.time() < deadline and not list((tmp_path / "log").rglob("*.parquet")):
            time.sleep(0.5)
    finally:
        query.stop()
    sweeps.sweep_once(latest, definitions, "2024-01-01 00:00:00", str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    totals = freshness.total_violations(log).first()
    assert totals.feature_name == "click" and totals.total_violations == totals.sweeps >= 2


def test_a_sweep_run_again_counts_once(spark, tmp_path):
    definitions = spark.createDataFrame([("click", 60, True)], "feature_name string, expected_freshness_seconds int, is_active boolean")
    latest = spark.createDataFrame([("c", "click")], "entity_id string, feature_name string").withColumn(
        "event_ts", F.lit("2023-12-31 00:00:00").cast("timestamp")
    )
    log = str(tmp_path / "log")
    for _ in range(2):
        sweeps.sweep_once(latest, definitions, "2024-01-01 00:00:00", log, "batch-1")
    sweeps.sweep_once(latest, definitions, "2024-01-01 00:00:15", log, "batch-2")
    assert spark.read.parquet(log).count() == 2
