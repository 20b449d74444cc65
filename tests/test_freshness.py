from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from freshet.functions import labels
from freshet.operators import freshness, joins, registry, retention

NOW = datetime(2024, 1, 1, 12)
AS_OF = "2024-01-01 12:00:00"


@pytest.fixture
def definitions(spark):
    return spark.createDataFrame(
        [("rolling_7d_spend", 45, True), ("order_count_24h", 60, True), ("old_feature", 10, False)],
        "feature_name string, expected_freshness_seconds int, is_active boolean",
    )


def latest(spark, *rows):
    """rows: (entity, feature, age in seconds or None)"""
    data = [(e, f, "1.5", "float", NOW - timedelta(seconds=a) if a is not None else None) for e, f, a in rows]
    return spark.createDataFrame(
        data, "entity_id string, feature_name string, value_raw string, value_type string, event_ts timestamp_ntz"
    )


def test_mixed_ages(spark, definitions):
    checked = freshness.monitored(
        latest(spark, ("a", "rolling_7d_spend", 10), ("b", "rolling_7d_spend", 100)), definitions, AS_OF
    )
    (row,) = freshness.sla_sweep(checked).collect()
    assert (row.feature_name, row.stale_count, row.total_count) == ("rolling_7d_spend", 1, 2)
    assert [r.entity_id for r in freshness.stale_entities(checked).collect()] == ["b"]


def test_exactly_at_the_limit_is_fresh(spark, definitions):
    checked = freshness.monitored(latest(spark, ("a", "rolling_7d_spend", 45)), definitions, AS_OF)
    assert not checked.first().is_stale


def test_unreadable_time_counts_but_is_not_stale(spark, definitions):
    (row,) = freshness.sla_sweep(freshness.monitored(latest(spark, ("a", "rolling_7d_spend", None)), definitions, AS_OF)).collect()
    assert (row.stale_count, row.total_count) == (0, 1)


def test_inactive_and_unknown_features_are_not_monitored(spark, definitions):
    assert freshness.monitored(latest(spark, ("a", "old_feature", 99), ("a", "other", 99)), definitions, AS_OF).isEmpty()


def test_entity_view_lists_all_active_features(spark, definitions):
    stored = latest(spark, ("a", "rolling_7d_spend", 100.126), ("a", "other", 5))
    rows = freshness.entity_freshness(spark.createDataFrame([("a",), ("a",)], "entity_id string"), definitions, stored, AS_OF)
    got = {r.feature_name: r for r in rows.collect()}
    assert set(got) == {"rolling_7d_spend", "order_count_24h"}
    assert (got["rolling_7d_spend"].is_stale, got["rolling_7d_spend"].age_seconds) == (True, 100.13)
    missing = got["order_count_24h"]
    assert (missing.is_stale, missing.value, missing.age_seconds, missing.freshness_sla_seconds) == (True, None, None, 60)
    summary = freshness.entity_summary(rows, with_features=True).first()
    assert (summary.total_features, summary.stale_features) == (2, 2)
    assert summary.features["rolling_7d_spend"].value == "1.5"


def test_totals_are_those_of_the_pairs(spark, definitions):
    stored = latest(spark, ("a", "rolling_7d_spend", 10), ("a", "other", 5), ("b", "rolling_7d_spend", 100), ("c", "order_count_24h", None))
    asked = spark.createDataFrame([("a",), ("b",), ("c",), ("x",)], "entity_id string")
    pairs = freshness.entity_summary(freshness.entity_freshness(asked, definitions, stored, AS_OF))
    totals = freshness.entity_totals(asked, definitions, stored, AS_OF)
    assert sorted(totals.collect()) == sorted(pairs.collect())
    assert {r.entity_id: r.stale_features for r in totals.collect()} == {"a": 1, "b": 2, "c": 1, "x": 2}


def test_single_answers(spark, definitions):
    stored = latest(spark, ("a", "rolling_7d_spend", 10), ("a", "other", 10_000))
    asked = [("a", "rolling_7d_spend"), ("a", "other"), ("a", "order_count_24h"), ("x", "nothing")]
    rows = freshness.requested_features(
        spark.createDataFrame(asked, "entity_id string, feature_name string"), definitions, stored, AS_OF
    ).collect()
    got = {(r.entity_id, r.feature_name): (r.is_stale, r.freshness_sla_seconds) for r in rows}
    assert got == {
        ("a", "rolling_7d_spend"): (False, 45),
        ("a", "other"): (False, None),
        ("a", "order_count_24h"): (True, 60),
        ("x", "nothing"): (True, None),
    }


def test_expiry_doubles_the_limit(spark, definitions):
    events = spark.createDataFrame(
        [("rolling_7d_spend", NOW), ("unknown", NOW)], "feature_name string, written_at timestamp_ntz"
    )
    got = {r.feature_name: (r.ttl_seconds, r.expires_at - NOW) for r in freshness.with_expiry(events, definitions).collect()}
    assert got == {"rolling_7d_spend": (90, timedelta(seconds=90)), "unknown": (240, timedelta(seconds=240))}
    kept = freshness.visible(freshness.with_expiry(events, definitions), "2024-01-01 12:01:30")
    assert [r.feature_name for r in kept.collect()] == ["unknown"]


def test_event_time_or_arrival_order(spark):
    rows = [("a", "f", "new", NOW, 1), ("a", "f", "late", NOW - timedelta(hours=1), 2)]
    df = spark.createDataFrame(rows, "entity_id string, feature_name string, v string, event_ts timestamp_ntz, offset int")
    assert freshness.latest_values(df, ["event_ts"]).first().v == "new"
    assert freshness.latest_values(df, ["offset"]).first().v == "late"


def test_health_and_bands(spark):
    sweep = spark.createDataFrame(
        [("a", 0, 0), ("b", 2, 100), ("c", 101, 1000), ("d", 1, 1000)], "feature_name string, stale_count bigint, total_count bigint"
    )
    got = {r.feature_name: (r.stale_percent, r.percent_band, r.count_band) for r in freshness.stale_bands(sweep).collect()}
    assert got == {"a": (0.0, "ok", "ok"), "b": (2.0, "warn", "ok"), "c": (10.1, "error", "error"), "d": (0.1, "ok", "ok")}
    assert freshness.health(sweep).first().asDict() == {
        "status": "degraded", "stale_feature_count": 104, "total_monitored_features": 2100,
    }
    assert freshness.health(sweep.limit(0)).first().status == "healthy"


@pytest.mark.parametrize(
    ("ms", "label", "band"),
    [(850.0, "850ms", "good"), (4999.0, "5.0s", "good"), (12_500.0, "12.5s", "warn"), (420_000.0, "7m", "stale"), (11_520_000.0, "3.2h", "stale")],
)
def test_freshness_words(spark, ms, label, band):
    row = spark.range(1).select(labels.freshness_label(F.lit(ms)), labels.freshness_band(F.lit(ms))).first()
    assert tuple(row) == (label, band)


def test_dimension_is_broadcast_only_while_small(spark):
    def hinted(df):
        return "isBroadcastable=true" in df._jdf.queryExecution().logical().toString() or "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    df = spark.range(100).withColumn("name", F.lit("x" * 50))
    assert hinted(joins.dimension(df))
    assert not hinted(joins.dimension(df, max_rows=99))
    assert not hinted(joins.dimension(df, max_bytes=1000))


def test_answers_do_not_depend_on_the_broadcast(spark, definitions, monkeypatch):
    stored = latest(spark, ("a", "rolling_7d_spend", 100), ("b", "order_count_24h", 5))
    small = sorted(map(tuple, freshness.monitored(stored, definitions, AS_OF).collect()))
    monkeypatch.setattr(freshness, "dimension", lambda df: df)
    assert sorted(map(tuple, freshness.monitored(stored, definitions, AS_OF).collect())) == small


# --- registry -------------------------------------------------------------------


def registry_of(spark, *rows):
    return spark.createDataFrame(
        [(n, "", "ml", s, "float", a, NOW, NOW) for n, s, a in rows], registry.SCHEMA.replace("timestamp", "timestamp_ntz")
    )


def changes_of(spark, *rows):
    """rows: (op, name, sla)"""
    data = [
        (op, name, None, "ml", sla, None, None, NOW + timedelta(minutes=i + 1), i) for i, (op, name, sla) in enumerate(rows)
    ]
    return spark.createDataFrame(
        data,
        "op string, feature_name string, description string, owner string, expected_freshness_seconds int, "
        "value_type string, is_active boolean, at timestamp_ntz, nr int",
    )


def merged(spark, old, *changes):
    df = registry.merge_definitions(old, changes_of(spark, *changes), ["nr"], "at")
    return {r.feature_name: r for r in df.collect()}


def test_registry_changes(spark):
    old = registry_of(spark, ("kept", 10, True), ("edited", 20, True), ("gone", 30, True), ("dead", 40, False))
    got = merged(
        spark, old, ("update", "edited", 21), ("delete", "gone", None), ("upsert", "dead", 41), ("create", "new", None),
        ("create", "kept", 99), ("update", "nobody", 5), ("delete", "nothing", None), ("upsert", "edited", -1),
    )
    assert {n: (r.expected_freshness_seconds, r.is_active) for n, r in got.items()} == {
        "kept": (10, True), "edited": (21, True), "gone": (30, False), "dead": (41, True), "new": (60, True),
    }
    assert got["kept"].updated_at == NOW
    assert got["edited"].created_at == NOW and got["edited"].updated_at > NOW
    assert got["new"].created_at == got["new"].updated_at == NOW + timedelta(minutes=4)
    assert (got["new"].value_type, got["new"].description) == ("float", "")


def test_changes_of_one_name_apply_in_order(spark):
    old = registry_of(spark, ("kept", 10, True))
    changes = [
        ("update", "new", 1), ("create", "new", 2), ("update", "new", None), ("create", "new", 9), ("delete", "kept", None),
        ("update", "kept", 11), ("upsert", "again", 3), ("delete", "again", None), ("upsert", "again", None), ("delete", "none", None),
    ]
    got = merged(spark, old, *changes)
    assert {n: (r.expected_freshness_seconds, r.is_active) for n, r in got.items()} == {
        "new": (2, True), "kept": (11, False), "again": (3, True),
    }
    assert got["new"].created_at == NOW + timedelta(minutes=2) and got["new"].updated_at == NOW + timedelta(minutes=3)
    refused = registry.refused_changes(old, changes_of(spark, *changes), ["nr"]).orderBy("nr").collect()
    assert [(r.op, r.feature_name, r.reason) for r in refused] == [
        ("update", "new", "unknown"), ("create", "new", "taken"), ("delete", "none", "unknown"),
    ]


def test_long_ids_stay_apart(spark):
    from freshet.plans.queries import _entity

    users = spark.createDataFrame([(7,), (123456,), (1234567,)], "user_id long")
    assert [r[0] for r in users.select(_entity()).collect()] == ["customer_00007", "customer_123456", "customer_1234567"]


def test_soft_delete_lists(spark):
    old = registry_of(spark, ("a", 10, True), ("b", 10, True))
    df = registry.merge_definitions(old, changes_of(spark, ("delete", "a", None)), ["nr"], "at")
    assert [r.feature_name for r in registry.list_definitions(df).collect()] == ["b"]
    assert registry.list_definitions(df, active_only=False).count() == 2


def test_change_errors(spark):
    rows = changes_of(spark, ("create", "a", 0), ("drop", "a", 1), ("create", "", 1), ("create", "x" * 256, 1), ("create", "a", 1))
    rows = rows.withColumn("value_type", F.when(F.col("nr") == 4, "decimal"))
    got = [r[0] for r in rows.orderBy("nr").select(registry.change_error(rows)).collect()]
    assert got == ["expected_freshness_seconds", "op", "feature_name", "feature_name", "value_type"]


def test_conflicts_and_unknown(spark):
    old = registry_of(spark, ("a", 10, False))
    rows = changes_of(spark, ("create", "a", 1), ("create", "b", 1))
    assert [r.feature_name for r in registry.conflicts(old, rows).collect()] == ["a"]
    assert [r.feature_name for r in registry.unknown_updates(old, rows).collect()] == ["b"]


# --- retention ------------------------------------------------------------------


def test_compaction(spark):
    minutes = [(1, "f", 5000), (2, "f", 200), (3, "f", 100), (4, "f", 30), (5, "f", 10), (6, "g", 90), (7, "g", 80)]
    log = spark.createDataFrame(
        [(o, "e", f, NOW - timedelta(minutes=m)) for o, f, m in minutes],
        "offset int, entity_id string, feature_name string, ts timestamp_ntz",
    )
    got = retention.compacted(log, "ts", ["offset"], AS_OF, keep_seconds=2 * 86_400)
    assert sorted(r.offset for r in got.collect()) == [3, 4, 5, 7]
