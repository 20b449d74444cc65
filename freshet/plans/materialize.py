"""The batch run: transactions in, verified feature table out."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from freshet.operators.features import wide_features
from freshet.operators.lookup import row_count, user_feature_vectors
from freshet.sources.sinks import write_features


def materialize_features(
    txns: DataFrame, output_path: str, reference_date: date | str, scale: int | None = 2, replace_dates_only: bool = False
) -> dict:
    """Compute the wide features, write them by date and read them back.

    Returns rows and dates found in the written table, and its columns.
    """
    write_features(wide_features(txns, reference_date, scale=scale), output_path, replace_dates_only)
    written = txns.sparkSession.read.parquet(output_path)
    counts = row_count(written).first()
    return {
        "row_count": counts["row_count"],
        "partitions": counts["partitions"],
        "schema_fields": written.columns,
        "output_path": output_path,
    }


def materialize_vectors(features: DataFrame, output_path: str) -> DataFrame:
    """Write one vector per user, sorted by user in each file, and read the table back."""
    user_feature_vectors(features).sortWithinPartitions("user_id").write.mode("overwrite").parquet(output_path)
    return features.sparkSession.read.parquet(output_path)


def feature_view(spark: SparkSession, path: str, name: str = "feature_store") -> DataFrame:
    """The written table as a view for SQL."""
    table = spark.read.parquet(path)
    table.createOrReplaceTempView(name)
    return table
