from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from freshet.operators import features
from freshet.plans.materialize import feature_view, materialize_features

SCHEMA = "user_id string, txn_id string, merchant_category string, amount double, event_date date"


def txns(spark, *rows):
    return spark.createDataFrame(
        [(u, f"t{i}", c, a, date.fromisoformat(d)) for i, (u, c, a, d) in enumerate(rows)], SCHEMA
    )


def one(df, **where):
    for k, v in where.items():
        df = df.filter(F.col(k) == v)
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_rolling_of_one_row_is_its_amount(spark):
    df = features.rolling_spend_avg(txns(spark, ("u1", "grocery", 200.0, "2024-01-05")))
    assert one(df).rolling_7d_spend_avg == 200.0
    assert df.columns == ["user_id", "txn_id", "event_date", "rolling_7d_spend_avg"]


def test_rolling_frame_covers_eight_dates_and_same_day_rows(spark):
    df = features.rolling_spend_avg(
        txns(
            spark,
            ("u", "a", 10.0, "2024-01-01"),
            ("u", "a", 20.0, "2024-01-08"),
            ("u", "a", 30.0, "2024-01-08"),
            ("u", "a", 40.0, "2024-01-09"),
        )
    )
    assert [r.rolling_7d_spend_avg for r in df.orderBy("txn_id").collect()] == [10.0, 20.0, 20.0, 30.0]


def test_rows_with_null_user_keep_their_own_group(spark):
    df = features.rolling_spend_avg(txns(spark, (None, "a", 10.0, "2024-01-01"), (None, "a", 30.0, "2024-01-01")))
    assert [r.rolling_7d_spend_avg for r in df.collect()] == [20.0, 20.0]


def test_null_amounts_do_not_count(spark):
    t = txns(spark, ("u", "a", None, "2024-01-01"), ("u", "a", 30.0, "2024-01-01"), ("v", "a", None, "2024-01-01"))
    got = {r.txn_id: r.rolling_7d_spend_avg for r in features.rolling_spend_avg(t).collect()}
    assert got == {"t0": 30.0, "t1": 30.0, "t2": None}


def test_top_category_and_tie(spark):
    t = txns(
        spark,
        ("u1", "grocery", 1.0, "2024-01-01"),
        ("u1", "grocery", 1.0, "2024-01-01"),
        ("u1", "dining", 1.0, "2024-01-01"),
        ("u2", "grocery", 1.0, "2024-01-01"),
        ("u2", "dining", 1.0, "2024-01-01"),
    )
    got = {r.user_id: (r.top_merchant_category, r.merchant_category_count) for r in features.top_merchant_category(t).collect()}
    assert got == {"u1": ("grocery", 2), "u2": ("dining", 1)}


def test_anomaly_zero_cases_and_outlier(spark):
    t = txns(
        spark,
        ("single", "a", 100.0, "2024-01-01"),
        ("flat", "a", 10.1, "2024-01-01"),
        ("flat", "a", 10.1, "2024-01-02"),
        ("flat", "a", 10.1, "2024-01-03"),
        ("out", "a", 10.0, "2024-01-01"),
        ("out", "a", 10.0, "2024-01-02"),
        ("out", "a", 500.0, "2024-01-03"),
    )
    for scale in (2, None):
        got = features.anomaly_scores(t, scale=scale).orderBy("txn_id").collect()
        assert [r.anomaly_score for r in got[:1]] == [0.0]
        assert got[6].anomaly_score == pytest.approx(1.1547, abs=1e-4)
    exact = features.anomaly_scores(t).orderBy("txn_id").collect()
    assert [r.anomaly_score for r in exact[:4]] == [0.0, 0.0, 0.0, 0.0]


def test_rfm(spark):
    t = txns(
        spark,
        ("u", "a", 50.0, "2024-01-05"),
        ("u", "a", 30.0, "2024-02-05"),
        ("u", "a", 0.1, "2024-02-01"),
    )
    row = one(features.rfm(t, date(2024, 2, 10)))
    assert (row.recency_days, row.frequency, row.monetary) == (5, 3, 80.1)


def test_amount_with_too_many_digits_stops_the_query(spark):
    t = txns(spark, ("u", "a", 1.005, "2024-01-01"))
    with pytest.raises(Exception, match="does not fit"):
        features.rfm(t, "2024-01-02").collect()
    assert one(features.rfm(t, "2024-01-02", scale=3)).frequency == 1
    assert one(features.wide_features(t, "2024-01-02", scale=None)).rolling_7d_spend_avg == 1.005


def test_wide_is_the_join_of_its_parts_and_keeps_duplicates(spark, small):
    from freshet.sources.tables import read_table, transactions

    t = transactions(read_table(spark, small, "events"))
    t = t.unionByName(t.limit(5))
    wide = features.wide_features(t, "2024-01-31")
    assert wide.columns == features.WIDE_COLUMNS
    assert wide.count() == t.count()
    for part in (features.rolling_spend_avg(t), features.anomaly_scores(t)):
        assert wide.select(*part.columns).exceptAll(part).isEmpty()
    for part in (features.top_merchant_category(t), features.rfm(t, "2024-01-31")):
        assert wide.select(*part.columns).distinct().exceptAll(part).isEmpty()


def test_wide_leaves_out_rows_without_a_key(spark):
    t = txns(spark, (None, "a", 1.0, "2024-01-01"), ("u", "a", 2.0, "2024-01-01"))
    assert [r.user_id for r in features.wide_features(t, "2024-01-02").collect()] == ["u"]


def test_scale_none_agrees_with_exact(spark, small):
    from freshet.sources.tables import read_table, transactions

    t = transactions(read_table(spark, small, "events"))
    a = features.wide_features(t, "2024-01-31").alias("a")
    b = features.wide_features(t, "2024-01-31", scale=None).alias("b")
    far = F.abs(F.col("a.anomaly_score") - F.col("b.anomaly_score")) > 1e-9
    far = far | (F.abs(F.col("a.rolling_7d_spend_avg") - F.col("b.rolling_7d_spend_avg")) > 1e-9)
    joined = a.join(b, F.col("a.txn_id") == F.col("b.txn_id"))
    assert joined.count() == t.count() and joined.filter(far).isEmpty()


def _hot_user(spark, rows: int):
    """A third of the rows belong to user 0, most of them on one date."""
    i = F.col("id")
    return spark.range(0, rows, 1, 16).select(
        F.when(i % 3 == 0, 0).otherwise(i % 997 + 1).alias("user_id"),
        i.alias("txn_id"),
        F.concat(F.lit("c"), (i % 7).cast("string")).alias("merchant_category"),
        ((i * 7919 % 100_000) / 100).alias("amount"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.when(i % 12 == 0, i % 30).otherwise(3).cast("int")).alias("event_date"),
    )


def test_hot_user_is_split_and_right(spark):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        t = _hot_user(spark, 120_000)
        wide = features.wide_features(t, "2024-03-01")
        wide.count()
        rows = wide.collect()
        plan = wide._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in plan and "skew=true" in plan
        assert len(rows) == 120_000
        w = (
            Window.partitionBy("user_id").orderBy(F.unix_date("event_date")).rangeBetween(-7, 0)
        )
        cents = F.round(F.col("amount") * 100).cast("bigint")
        brute = t.select("txn_id", (F.sum(cents).over(w) / F.count("*").over(w) / 100).alias("expected"))
        for single in (features.rolling_spend_avg(t), features.anomaly_scores(t)):
            assert len(single.collect()) == 120_000
            assert "skew=true" in single._jdf.queryExecution().executedPlan().toString()
        off = wide.join(brute, "txn_id").filter(F.abs(F.col("expected") - F.col("rolling_7d_spend_avg")) > 1e-9)
        assert off.isEmpty()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_written_table_is_split_by_date_and_replaces_only_its_dates(spark, tmp_path):
    path = str(tmp_path / "features")
    t = txns(spark, ("u", "a", 1.0, "2024-01-01"), ("u", "a", 2.0, "2024-01-02"), ("v", "b", 3.0, "2024-01-02"))
    result = materialize_features(t, path, "2024-01-31")
    assert (result["row_count"], result["partitions"]) == (3, 2)
    assert set(result["schema_fields"]) == set(features.WIDE_COLUMNS)
    view = feature_view(spark, path)
    assert dict(view.dtypes)["event_date"] == "date"
    assert spark.sql("SELECT count(*) AS n FROM feature_store WHERE event_date = DATE '2024-01-02'").first().n == 2
    again = txns(spark, ("w", "a", 9.0, "2024-01-02"))
    assert materialize_features(again, path, "2024-01-31", replace_dates_only=True)["row_count"] == 2


def test_deviation_beyond_exact_decimals(spark):
    from freshet.functions.amounts import sample_std

    row = spark.sql("SELECT 4000000000000000000L AS n, 9000000000000000000L AS s, cast(1e30 AS decimal(38,0)) AS q")
    got = row.select(sample_std(F.col("n"), F.col("s"), F.col("q"), 2).alias("x")).first()["x"]
    assert abs(got - (1e30 / 4e18) ** 0.5 / 100) < 1e-3 * got
