"""Reads on the wide feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.amounts import mean

# How each metric is reduced to one number per user, and the
# features of the drift summary.
METRIC_AGGREGATES = {
    "recency_days": "max",
    "frequency": "max",
    "monetary": "max",
    "rolling_7d_spend_avg": "avg",
    "anomaly_score": "avg",
    "merchant_category_count": "max",
}
DRIFT_FEATURES = [
    "rolling_7d_spend_avg",
    "anomaly_score",
    "recency_days",
    "frequency",
    "monetary",
    "merchant_category_count",
]


def between_dates(features: DataFrame, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """Keep some event dates; on a date-partitioned table only those are read."""
    if date_from is not None:
        features = features.filter(F.col("event_date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        features = features.filter(F.col("event_date") <= F.lit(date_to).cast("date"))
    return features


def _metric(name: str, digits: int | None) -> Column:
    if name not in METRIC_AGGREGATES:
        raise ValueError(f"no such metric: {name!r} (there are {', '.join(sorted(METRIC_AGGREGATES))})")
    value = {"avg": F.avg, "max": F.max}[METRIC_AGGREGATES[name]](name)
    return F.round(value, digits) if digits is not None and METRIC_AGGREGATES[name] == "avg" else value


def user_feature_vectors(
    features: DataFrame, user_id=None, latest_only: bool = False, digits: int | None = None
) -> DataFrame:
    """One feature vector per user, or of one user.

    Means of the per-transaction features, maxima of the per-user ones.
    ``latest_only`` first keeps the rows of each user's newest date.
    """
    if user_id is not None:
        features = features.filter(F.col("user_id") == F.lit(user_id))
    names = list(METRIC_AGGREGATES)
    if latest_only:
        per_date = features.groupBy("user_id", "event_date").agg(
            *[
                F.sum(n).alias(n) if METRIC_AGGREGATES[n] == "avg" else F.max(n).alias(n)
                for n in names
            ],
            *[F.count(n).alias(f"{n}_n") for n in names if METRIC_AGGREGATES[n] == "avg"],
            F.max("top_merchant_category").alias("top_merchant_category"),
        )
        newest = Window.partitionBy("user_id").orderBy(F.col("event_date").desc())
        kept = per_date.withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") == 1)
        columns = [
            mean(F.col(n), F.col(f"{n}_n"), None) if METRIC_AGGREGATES[n] == "avg" else F.col(n) for n in names
        ]
        columns = [
            (F.round(c, digits) if digits is not None and METRIC_AGGREGATES[n] == "avg" else c).alias(n)
            for c, n in zip(columns, names)
        ]
        return kept.select("user_id", "top_merchant_category", *columns)
    return features.groupBy("user_id").agg(
        F.max("top_merchant_category").alias("top_merchant_category"),
        *[_metric(n, digits).alias(n) for n in names],
    )


def top_k_users(
    features: DataFrame, k: int = 10, metric: str = "monetary", ascending: bool = False, digits: int | None = None
) -> DataFrame:
    """The ``k`` users with the largest (or smallest) metric.

    Users without a value come last; ties go by ``user_id``. With ``digits``
    means are rounded before ranking, so the last bits of a double do not rank.
    """
    per_user = features.groupBy("user_id").agg(_metric(metric, digits).alias(metric))
    return _first_users(per_user, k, metric, ascending)


def top_k_vectors(
    vectors: DataFrame, k: int = 10, metric: str = "monetary", ascending: bool = False, digits: int | None = None
) -> DataFrame:
    """``top_k_users`` from a table with one vector per user: nothing is grouped or shuffled but the ``k`` rows."""
    _metric(metric, digits)
    value = F.round(metric, digits) if digits is not None and METRIC_AGGREGATES[metric] == "avg" else F.col(metric)
    return _first_users(vectors.select("user_id", value.alias(metric)), k, metric, ascending)


def _first_users(per_user: DataFrame, k: int, metric: str, ascending: bool) -> DataFrame:
    value = F.col(metric)
    order = value.asc_nulls_last() if ascending else value.desc_nulls_last()
    return per_user.orderBy(order, "user_id").limit(int(k))


def drift_summary(features: DataFrame, names: list[str] | None = None) -> DataFrame:
    """``feature, mean, std, min, max`` over the whole table, zeros where there is none."""
    names = names or DRIFT_FEATURES
    row = features.agg(
        *[
            F.struct(
                F.lit(n).alias("feature"),
                *[
                    F.coalesce(f(n).cast("double"), F.lit(0.0)).alias(stat)
                    for stat, f in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))
                ],
            ).alias(n)
            for n in names
        ]
    )
    return row.select(F.explode(F.array(*names)).alias("s")).select("s.*")


def row_count(features: DataFrame) -> DataFrame:
    """Rows and distinct dates of the table."""
    return features.groupBy("event_date").agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count("event_date").alias("partitions")
    )


def rows_per_date(features: DataFrame) -> DataFrame:
    return features.groupBy("event_date").agg(F.count("*").alias("row_count"))


def most_recent(events: DataFrame, ts: str, tie: str, n: int = 20) -> DataFrame:
    return events.orderBy(F.col(ts).desc(), F.col(tie).desc()).limit(n)
