"""Per-user and per-transaction spend features.

Input: transactions ``user_id, txn_id, merchant_category, amount, event_date``.

One user may own a third of all rows, so no operator here sends the rows of a
user to one task. Rows are first reduced per (user, date) or (user, category)
with map-side combine; windows run over those few rows; the results are joined
back to the transactions.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.amounts import mean, rounded_amount, sample_std, square_sum, units
from freshet.operators.joins import attach

WIDE_COLUMNS = [
    "user_id",
    "txn_id",
    "event_date",
    "rolling_7d_spend_avg",
    "anomaly_score",
    "top_merchant_category",
    "merchant_category_count",
    "recency_days",
    "frequency",
    "monetary",
]


def _daily_rolling(txns: DataFrame, days: int, scale: int | None) -> DataFrame:
    """Per (user, date): sum and count of the dates ``[date - days, date]``."""
    amount = units("amount", scale)
    daily = txns.groupBy("user_id", "event_date").agg(
        F.sum(amount).alias("day_sum"), F.count("amount").alias("day_n")
    )
    frame = Window.partitionBy("user_id").orderBy(F.unix_date("event_date")).rangeBetween(-days, 0)
    return daily.select(
        "user_id",
        "event_date",
        F.sum("day_sum").over(frame).alias("frame_sum"),
        F.sum("day_n").over(frame).alias("frame_n"),
    )


def rolling_spend_avg(txns: DataFrame, days: int = 7, scale: int | None = 2) -> DataFrame:
    """Mean amount of the user over the dates ``[event_date - days, event_date]``.

    Both ends count, so seven days back means eight calendar dates.
    """
    rolling = _daily_rolling(txns, days, scale)
    return attach(txns, rolling, ["user_id", "event_date"]).select(
        "user_id",
        "txn_id",
        "event_date",
        mean(F.col("frame_sum"), F.col("frame_n"), scale).alias("rolling_7d_spend_avg"),
    )


def category_counts(txns: DataFrame) -> DataFrame:
    return txns.groupBy("user_id", "merchant_category").agg(F.count("*").alias("cat_count"))


def _best_category(count: Column, category: Column) -> Column:
    """Aggregate: most frequent category, first in order on a tie."""
    return F.min(F.struct((-count).alias("neg_count"), category.alias("category")))


def top_merchant_category(txns: DataFrame) -> DataFrame:
    """Most frequent category of each user with its count."""
    best = (
        category_counts(txns)
        .groupBy("user_id")
        .agg(_best_category(F.col("cat_count"), F.col("merchant_category")).alias("best"))
    )
    return best.select(
        "user_id",
        F.col("best.category").alias("top_merchant_category"),
        (-F.col("best.neg_count")).alias("merchant_category_count"),
    )


def anomaly_scores(txns: DataFrame, scale: int | None = 2) -> DataFrame:
    """z-score of each amount against its user; 0 where there is no deviation."""
    amount = units("amount", scale)
    stats = txns.groupBy("user_id").agg(
        F.count("amount").alias("n"), F.sum(amount).alias("s1"), square_sum(amount, scale).alias("s2")
    )
    stats = stats.select(
        "user_id",
        mean(F.col("s1"), F.col("n"), scale).alias("user_mean"),
        sample_std(F.col("n"), F.col("s1"), F.col("s2"), scale).alias("user_std"),
    )
    return attach(txns, stats, ["user_id"]).select(
        "user_id", "txn_id", "event_date", _z_score().alias("anomaly_score")
    )


def _z_score() -> Column:
    flat = F.col("user_std").isNull() | (F.col("user_std") == 0)
    return F.when(flat, F.lit(0.0)).otherwise((F.col("amount") - F.col("user_mean")) / F.col("user_std"))


def rfm(txns: DataFrame, reference_date: date | str, scale: int | None = 2) -> DataFrame:
    """Recency in days before ``reference_date``, frequency and monetary total."""
    return txns.groupBy("user_id").agg(
        F.datediff(F.lit(str(reference_date)).cast("date"), F.max("event_date")).alias("recency_days"),
        F.count("*").alias("frequency"),
        rounded_amount(F.sum(units("amount", scale)), 2, scale).alias("monetary"),
    )


def wide_features(
    txns: DataFrame, reference_date: date | str, days: int = 7, scale: int | None = 2
) -> DataFrame:
    """One row per transaction with every feature of this module.

    Two reductions (per user and category, per user and date) meet in a small
    per-(user, date) table that carries everything but the z-score itself, so
    the transactions are shuffled once, on (user, date). Rows without a user,
    id or date have no place in the output.
    """
    keyed = txns.filter(
        F.col("user_id").isNotNull() & F.col("txn_id").isNotNull() & F.col("event_date").isNotNull()
    )
    amount = units("amount", scale)
    per_category = keyed.groupBy("user_id", "merchant_category").agg(
        F.count("*").alias("rows"),
        F.count("amount").alias("n"),
        F.sum(amount).alias("s1"),
        square_sum(amount, scale).alias("s2"),
        F.max("event_date").alias("last_date"),
    )
    per_user = per_category.groupBy("user_id").agg(
        _best_category(F.col("rows"), F.col("merchant_category")).alias("best"),
        F.sum("rows").alias("frequency"),
        F.sum("n").alias("n"),
        F.sum("s1").alias("s1"),
        F.sum("s2").alias("s2"),
        F.max("last_date").alias("last_date"),
    )
    per_user = per_user.select(
        "user_id",
        F.col("best.category").alias("top_merchant_category"),
        (-F.col("best.neg_count")).alias("merchant_category_count"),
        F.datediff(F.lit(str(reference_date)).cast("date"), F.col("last_date")).alias("recency_days"),
        "frequency",
        rounded_amount(F.col("s1"), 2, scale).alias("monetary"),
        mean(F.col("s1"), F.col("n"), scale).alias("user_mean"),
        sample_std(F.col("n"), F.col("s1"), F.col("s2"), scale).alias("user_std"),
    )
    per_user_date = (
        _daily_rolling(keyed, days, scale)
        .select(
            "user_id",
            "event_date",
            mean(F.col("frame_sum"), F.col("frame_n"), scale).alias("rolling_7d_spend_avg"),
        )
        .join(per_user, "user_id")
    )
    rows = keyed.select("user_id", "txn_id", "event_date", "amount")
    return (
        rows.join(per_user_date, ["user_id", "event_date"])
        .withColumn("anomaly_score", _z_score())
        .select(*WIDE_COLUMNS)
    )
