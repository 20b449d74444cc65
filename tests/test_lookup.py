from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from freshet.operators import lookup


@pytest.fixture(scope="module")
def table(spark):
    i = F.col("id")
    return spark.range(5000).select(
        F.concat(F.lit("user_"), F.lpad((i % 100).cast("string"), 6, "0")).alias("user_id"),
        i.cast("string").alias("txn_id"),
        ((i % 500) + 0.5).alias("rolling_7d_spend_avg"),
        F.element_at(F.array(*[F.lit(c) for c in ("grocery", "dining", "travel")]), (i % 3 + 1).cast("int")).alias("top_merchant_category"),
        (i % 20).cast("int").alias("merchant_category_count"),
        ((i % 60) / 10 - 3).alias("anomaly_score"),
        (i % 30).cast("int").alias("recency_days"),
        (i % 50).cast("int").alias("frequency"),
        (i % 5000 * 1.0).alias("monetary"),
        F.date_add(F.lit("2024-01-01").cast("date"), (i % 30).cast("int")).alias("event_date"),
    )


def test_user_vector(spark, table):
    (row,) = lookup.user_feature_vectors(table, "user_000042").collect()
    mine = table.filter("user_id = 'user_000042'")
    assert row.monetary == mine.agg(F.max("monetary")).first()[0]
    assert row.rolling_7d_spend_avg == pytest.approx(mine.agg(F.avg("rolling_7d_spend_avg")).first()[0])
    assert lookup.user_feature_vectors(table, "nobody").isEmpty()
    assert lookup.user_feature_vectors(table).count() == 100


def test_latest_only(spark, table):
    row = lookup.user_feature_vectors(table, "user_000042", latest_only=True).first()
    mine = table.filter("user_id = 'user_000042'")
    newest = mine.filter(F.col("event_date") == mine.agg(F.max("event_date")).first()[0])
    assert row.rolling_7d_spend_avg == pytest.approx(newest.agg(F.avg("rolling_7d_spend_avg")).first()[0])
    assert row.frequency == newest.agg(F.max("frequency")).first()[0]


@pytest.mark.parametrize("metric", sorted(lookup.METRIC_AGGREGATES))
@pytest.mark.parametrize("ascending", [True, False])
def test_top_k_is_ordered(table, metric, ascending):
    rows = lookup.top_k_users(table, 7, metric, ascending).collect()
    values = [r[metric] for r in rows]
    assert len(rows) == 7 and values == sorted(values, reverse=not ascending)


@pytest.mark.parametrize("metric", sorted(lookup.METRIC_AGGREGATES))
def test_top_k_of_vectors_is_that_of_rows(table, metric):
    vectors = lookup.user_feature_vectors(table)
    for digits in (None, 1):
        expected = lookup.top_k_users(table, 9, metric, digits=digits).collect()
        assert lookup.top_k_vectors(vectors, 9, metric, digits=digits).collect() == expected


def test_top_k_puts_missing_last(spark, table):
    extra = table.limit(1).withColumn("user_id", F.lit("aaa")).withColumn("monetary", F.lit(None).cast("double"))
    rows = lookup.top_k_users(table.unionByName(extra), 101, "monetary", ascending=True).collect()
    assert rows[-1].user_id == "aaa" and rows[0].monetary is not None


def test_unknown_metric(table):
    with pytest.raises(ValueError, match="no such metric"):
        lookup.top_k_users(table, 5, "txn_id")


def test_drift(table):
    rows = {r.feature: r for r in lookup.drift_summary(table).collect()}
    assert set(rows) == set(lookup.DRIFT_FEATURES)
    for r in rows.values():
        assert r["min"] <= r["mean"] <= r["max"] and r["std"] >= 0
    empty = {r.feature: r["mean"] for r in lookup.drift_summary(table.limit(0)).collect()}
    assert set(empty.values()) == {0.0}


def test_counts(table):
    assert tuple(lookup.row_count(table).first()) == (5000, 30)
    assert lookup.rows_per_date(table).agg(F.sum("row_count")).first()[0] == 5000
    assert tuple(lookup.row_count(table.limit(0)).first()) == (0, 0)


def test_dates_prune_partitions(spark, table, tmp_path):
    path = str(tmp_path / "t")
    table.write.partitionBy("event_date").parquet(path)
    df = lookup.between_dates(spark.read.parquet(path), "2024-01-05", "2024-01-06")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert df.select("event_date").distinct().count() == 2
