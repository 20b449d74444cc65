"""Table readers and the mappings onto the data model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def file_states(table: DataFrame) -> list[tuple[str, int, int]]:
    """Name, length and time of change of a table's files: what differs after a file was overwritten in place."""
    jvm, conf = table.sparkSession._jvm, table.sparkSession._jsc.hadoopConfiguration()

    def state(name: str) -> tuple[str, int, int]:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        status = path.getFileSystem(conf).getFileStatus(path)
        return name, status.getLen(), status.getModificationTime()

    return [state(name) for name in sorted(table.inputFiles())]


def transactions(events: DataFrame) -> DataFrame:
    """Events as transactions: one row per event, category = event type."""
    return events.select(
        "user_id",
        F.col("event_id").alias("txn_id"),
        F.col("event_type").alias("merchant_category"),
        F.col("value").alias("amount"),
        F.to_date("ts").alias("event_date"),
    )


def window_events(events: DataFrame) -> DataFrame:
    """Events for window aggregation: ``ts, user_id, amount, event_type``."""
    return events.select("ts", "user_id", F.col("value").alias("amount"), "event_type")


def orders_by_customer(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_custkey").alias("entity_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_totalprice").alias("amount"),
    )
