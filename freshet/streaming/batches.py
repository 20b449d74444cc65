"""Tables written by micro-batches.

Each micro-batch owns the folder ``batch_id=<n>`` and replaces it when it is
run again, so a restart after a failure leaves neither gaps nor repeats.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    (
        rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


def triggered(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """Run every ``interval``, or with None over what is there and then stop."""
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
