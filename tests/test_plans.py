"""What the plans must look like, whatever the data."""

from __future__ import annotations

import json
import re
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__
from freshet.operators import features, lookup, retention, trailing, windows
from freshet.plans.queries import QUERIES
from freshet.sources import sinks
from freshet.sources.tables import orders_by_customer, read_table, transactions, window_events

ROOT = Path(__file__).resolve().parent.parent


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_points(spark):
    flagship = __spark_entry__.entry(spark)
    assert flagship.columns == features.WIDE_COLUMNS and flagship.count() == 1000
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_cross_join_and_no_python(spark, small, name):
    text = plan(QUERIES[name](spark, small))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|Pandas|ArrowEval", text)


def test_point_filters_reach_the_scan(spark, small):
    events = read_table(spark, small, "events")
    text = plan(windows.sliding_at(window_events(events), "2024-01-15 12:00:00", 60))
    assert "GreaterThanOrEqual(ts" in text and "LessThanOrEqual(ts" in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in text
    assert "GreaterThanOrEqual(ts" in plan(retention.retained(events, "ts", "2024-01-31 00:00:00", 86_400))


def test_old_lake_folders_are_not_read(spark, small, tmp_path):
    events = read_table(spark, small, "events")
    sinks.write_raw_events(events, str(tmp_path / "raw"), "ts")
    kept = retention.retained_folders(spark.read.parquet(str(tmp_path / "raw")), "ts", "2024-01-31 00:00:00", 86_400)
    assert kept.count() == events.filter("ts >= '2024-01-30'").count()
    assert re.search(r"PartitionFilters: \[.*make_date", plan(kept)) and "GreaterThanOrEqual(ts" in plan(kept)


def test_user_filter_reaches_the_scan_of_a_written_table(spark, small, tmp_path):
    from freshet.plans.materialize import materialize_features

    materialize_features(transactions(read_table(spark, small, "events")), str(tmp_path / "f"), "2024-01-31")
    text = plan(lookup.user_feature_vectors(spark.read.parquet(str(tmp_path / "f")), 7))
    assert "EqualTo(user_id,7)" in text and "txn_id" not in text.split("ReadSchema")[1]


def test_wide_moves_the_transactions_once(spark, small):
    """Without broadcasts: one exchange of the transactions, the others carry reduced rows."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(features.wide_features(transactions(read_table(spark, small, "events")), "2024-01-31"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    exchanges = re.findall(r"Exchange hashpartitioning\(.*", text)
    assert len(exchanges) == 6
    below = [text[m.end():].split("\n")[1] for m in re.finditer(r"Exchange hashpartitioning\(.*", text)]
    assert sum("Aggregate" not in line and "Project" in line or "Filter" in line for line in below) <= 2


def test_top_k_never_sorts_everything(spark, small):
    table = features.wide_features(transactions(read_table(spark, small, "events")), "2024-01-31")
    assert "TakeOrderedAndProject" in plan(lookup.top_k_users(table, 5))
    assert "TakeOrderedAndProject" in plan(lookup.most_recent(read_table(spark, small, "events"), "ts", "event_id"))


def test_newest_rows_are_cut_before_the_shuffle(spark, small):
    orders = orders_by_customer(read_table(spark, small, "orders"))
    text = plan(trailing.latest_rows_mean(orders, "entity_id", "ts", "order_id", "amount", 30))
    assert re.search(r"WindowGroupLimit.*Partial", text)


def test_histories_are_partitioned_by_entity_and_time(spark, small):
    events = read_table(spark, small, "events").select("event_id", "user_id", "ts", "value")
    text = plan(trailing.trailing_totals(events, "user_id", "ts", 86_400, "value"))
    # only the per-bucket totals are brought together by entity alone
    by_entity = re.findall(r"Exchange hashpartitioning\(entity#\d+L?, 8\)", text)
    assert len(by_entity) == 1
    assert len(re.findall(r"Exchange hashpartitioning\(entity#\d+L?, [^,]*bucket", text)) >= 1


def test_nothing_named_after_a_local_checkpoint():
    files = {p.name: p.read_text() for p in (ROOT / "freshet").rglob("*.py")}
    code = "\n".join(files.values())
    for banned in ("localCheckpoint", "toPandas", "crossJoin", "udf("):
        assert banned not in code
    # One operator is defined by an operation that only RDDs have: repartitionAndSortWithinPartitions.
    assert {name for name, text in files.items() if ".rdd" in text} <= {"fill_middle.py"}


def test_bench_prints_one_line_of_json(small):
    import os

    env = {**os.environ, "BENCH_SF_DIR": small, "BENCH_CPUS": "4", "BENCH_RUNS": "1", "BENCH_QUERIES": "rfm,tumbling_1hr"}
    done = subprocess.run([sys.executable, str(ROOT / "bench.py")], env=env, capture_output=True, text=True, timeout=300)
    (line,) = [text for text in done.stdout.splitlines() if text.strip()]
    report = json.loads(line)
    assert set(report["queries"]) == {"rfm", "tumbling_1hr"} and report["sf"] == 0.001
    assert report["value"] == pytest.approx(sum(report["queries"].values()), abs=0.01)
