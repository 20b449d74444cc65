"""Trailing windows, sessions and point-in-time rows against brute force."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from freshet.functions.clock import DAY, SECOND, micros
from freshet.operators import point_in_time, runs, sessions, trailing

START = datetime(2024, 1, 1)


def history(seed: int, n: int = 120, users: int = 3, spread: int = 400):
    """Rows on a coarse clock, so times repeat and fall on bucket borders."""
    rng = random.Random(seed)
    return [
        (i, rng.randrange(users), START + timedelta(seconds=10 * rng.randrange(spread)), rng.randrange(10_000) / 100)
        for i in range(n)
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, who int, ts timestamp_ntz, amount double").repartition(4)


def test_trailing_totals(spark):
    rows = history(1)
    for width, bucket in ((300, 60), (300, 1000), (60, 600), (0, 100)):
        got = {
            r.id: (r.trailing_count, r.trailing_sum)
            for r in trailing.trailing_totals(
                frame(spark, rows), "who", "ts", width, "amount", bucket_seconds=bucket
            ).collect()
        }
        for i, who, ts, _ in rows:
            inside = [a for _, w, t, a in rows if w == who and ts - timedelta(seconds=width) <= t <= ts]
            assert got[i] == (len(inside), sum(round(a * 100) for a in inside) / 100)


def test_trailing_totals_keep_rows_without_time_or_amount(spark):
    rows = [(1, 1, START, None), (2, 1, START, 2.0), (3, 1, None, 5.0)]
    got = {r.id: (r.trailing_count, r.trailing_sum) for r in trailing.trailing_totals(frame(spark, rows), "who", "ts", 60, "amount").collect()}
    assert got == {1: (2, 2.0), 2: (2, 2.0), 3: (None, None)}


def test_positions(spark):
    rows = history(2)
    for bucket in (60, 700, 100_000):
        got = {r.id: r.position for r in trailing.numbered(frame(spark, rows), "who", "ts", "id", bucket).collect()}
        for i, who, ts, _ in rows:
            assert got[i] == sum(1 for j, w, t, _ in rows if w == who and (t, j) <= (ts, i))


def test_mean_of_the_last_rows(spark):
    rows = history(3)
    for n, run in ((5, 7), (5, 5), (30, 1000), (1, 3)):
        df = trailing.last_rows_mean(frame(spark, rows), "who", "ts", "id", "amount", n, bucket_seconds=500, run_length=run)
        got = {r.id: r.trailing_mean for r in df.collect()}
        assert len(got) == len(rows)
        for i, who, ts, _ in rows:
            upto = sorted((t, j, a) for j, w, t, a in rows if w == who and (t, j) <= (ts, i))[-n:]
            assert got[i] == sum(round(a * 100) for *_, a in upto) / 100 / len(upto)


def test_mean_of_the_newest_rows(spark):
    rows = history(4)
    got = {r.who: (r.latest_mean, r.rows_used) for r in trailing.latest_rows_mean(frame(spark, rows), "who", "ts", "id", "amount", 7).collect()}
    for who in {r[1] for r in rows}:
        newest = sorted((t, j, a) for j, w, t, a in rows if w == who)[-7:]
        assert got[who] == (sum(round(a * 100) for *_, a in newest) / 100 / 7, 7)


def test_days_since_last(spark):
    rows = [(1, 1, datetime(2024, 1, 1), 1.0), (2, 1, datetime(2024, 1, 3, 12), 1.0), (3, 1, datetime(2024, 2, 1), 1.0)]
    (row,) = trailing.days_since_last(frame(spark, rows), "who", "ts", "2024-01-05 00:00:00").collect()
    assert row.days_since_last == 1.5


def test_point_in_time(spark):
    rows = history(5, n=200)
    labels, known = [r for r in rows if r[0] % 3 == 0], [r for r in rows if r[0] % 3]
    for bucket in (50, 777, 100_000):
        df = point_in_time.point_in_time(
            frame(spark, labels), frame(spark, known), "who", "ts", "id", "amount", bucket_seconds=bucket
        )
        got = {r.id: (r.feature_value, r.feature_ts) for r in df.collect()}
        assert len(got) == len(labels)
        for i, who, ts, _ in labels:
            seen = max(((t, j, a) for j, w, t, a in known if w == who and t <= ts), default=None)
            assert got[i] == ((seen[2], seen[0]) if seen else (None, None))


def test_point_in_time_keeps_a_newer_null_and_labels_of_strangers(spark):
    labels = frame(spark, [(1, 1, START + timedelta(seconds=100), 0.0), (2, 9, START, 0.0)])
    known = frame(spark, [(3, 1, START, 5.0), (4, 1, START + timedelta(seconds=50), None)])
    got = {r.id: (r.feature_value, r.feature_ts) for r in point_in_time.point_in_time(labels, known, "who", "ts", "id", "amount").collect()}
    assert got == {1: (None, START + timedelta(seconds=50)), 2: (None, None)}


def test_point_in_time_per_feature(spark):
    rows = history(6, n=150)
    labels = rows[:40]
    known = frame(spark, rows[40:]).withColumn("name", F.concat(F.lit("f"), (F.col("id") % 3).cast("string")))
    df = point_in_time.point_in_time(
        frame(spark, labels), known, "who", "ts", "id", "amount", "name", ["f0", "f2"], bucket_seconds=300
    )
    for r in df.collect():
        for k in (0, 2):
            seen = max(((t, j, a) for j, w, t, a in rows[40:] if w == r.who and t <= r.ts and j % 3 == k), default=None)
            assert (r[f"f{k}"], r[f"f{k}_ts"]) == ((seen[2], seen[0]) if seen else (None, None))


def hot_history(spark, n: int = 20_000):
    """Most rows of one user on one day, a tenth of them at one moment; others have few."""
    i = F.col("id")
    second = F.when(i % 10 == 0, 40_000).otherwise((i * 7919) % 86_400)
    return spark.range(n, numPartitions=4).select(
        i.cast("int").alias("id"),
        F.when(i % 50 == 0, i % 7 + 2).when(i % 51 == 0, F.lit(None)).otherwise(1).cast("int").alias("who"),
        F.timestamp_seconds(F.lit(1_704_067_200) + second).cast("timestamp_ntz").alias("ts"),
        (i % 977 / 4).alias("amount"),
    )


def test_hot_buckets_are_cut_by_rows(spark):
    rows = hot_history(spark)
    keyed = rows.select(F.col("who").alias("entity"), micros("ts").alias("t"))
    starts = runs.hot_starts(keyed, DAY * SECOND, 500)
    cut = runs.with_runs(keyed, DAY * SECOND, starts).groupBy("entity", "bucket").agg(
        F.count("*").alias("n"), F.countDistinct("t").alias("moments"), F.min("t").alias("first"), F.max("t").alias("last")
    )
    got = sorted(cut.filter("entity = 1").collect(), key=lambda r: r.bucket)
    assert len(got) > 20 and sum(r.n for r in got) == rows.filter("who = 1").count()
    # rows of one moment stay together, beyond that a run is hardly over its length
    assert all(r.n <= 520 or r.n < 2_600 and r.first <= 1_704_107_200 * SECOND <= r.last for r in got)
    assert all(a.last < b.bucket <= b.first for a, b in zip(got, got[1:]))
    assert runs.hot_starts(keyed, DAY * SECOND, 50_000) is None


def test_cut_histories_give_the_same_rows(spark):
    rows = hot_history(spark)
    known, labels = rows.filter("id % 3 > 0"), rows.filter("id % 3 = 0")

    def both(make):
        whole, cut = make(10**9), make(300)
        assert cut.exceptAll(whole).isEmpty() and whole.exceptAll(cut).isEmpty()

    both(lambda n: trailing.trailing_totals(rows, "who", "ts", 3600, "amount", rows_per_run=n))
    both(lambda n: trailing.numbered(rows, "who", "ts", "id", rows_per_run=n))
    both(lambda n: trailing.last_rows_mean(rows, "who", "ts", "id", "amount", 30, run_length=n))
    both(lambda n: point_in_time.point_in_time(labels, known, "who", "ts", "id", "amount", rows_per_run=n))


def brute_sessions(rows, gap):
    out = []
    for who in {r[1] for r in rows}:
        times = sorted(t for _, w, t, _ in rows if w == who)
        runs = [[times[0]]]
        for t in times[1:]:
            if t - runs[-1][-1] > timedelta(seconds=gap):
                runs.append([])
            runs[-1].append(t)
        out += [(who, run[0], run[-1] + timedelta(seconds=gap), len(run)) for run in runs]
    return sorted(out)


def test_sessions(spark):
    rows = history(7)
    for gap in (0, 10, 40, 100, 10_000):
        df = sessions.sessions(frame(spark, rows), "who", "ts", gap)
        got = sorted((r.who, r.session_start, r.session_end, r.event_count) for r in df.collect())
        assert got == brute_sessions(rows, gap)


def test_sessions_agree_with_session_window(spark):
    df = frame(spark, history(8))
    spark_own = df.groupBy(F.session_window("ts", "50 seconds").alias("w"), "who").agg(F.count("*").alias("event_count"))
    spark_own = spark_own.select("who", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "event_count")
    ours = sessions.sessions(df, "who", "ts", 50)
    assert ours.exceptAll(spark_own).isEmpty() and spark_own.exceptAll(ours).isEmpty()


def test_session_counts_cover_every_hour_of_a_session(spark):
    rows = [(i, 1, START + timedelta(minutes=20 * i), 1.0) for i in range(7)] + [(9, 1, START + timedelta(hours=5), 1.0)]
    got = {r.window_start.hour: r.session_count for r in sessions.session_counts(frame(spark, rows), "who", "ts", 1800).collect()}
    assert got == {0: 1, 1: 1, 2: 1, 5: 1}


def test_active_sessions(spark):
    rows = [(1, 1, START, 1.0), (2, 1, START + timedelta(minutes=50), 1.0), (3, 2, START - timedelta(hours=3), 1.0)]
    df = sessions.active_sessions(frame(spark, rows), "who", "ts", 600, "2024-01-01 01:00:00")
    assert [(r.who, r.session_count) for r in df.collect()] == [(1, 2)]
