"""What streams report about themselves, kept as a table.

Each micro-batch reports counts with its progress. A listener on the driver
writes one row per batch, so the last run and the counts so far can be read when
the query has long stopped, and by other sessions. A batch that is reported
again, after a restart, counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from freshet.operators.freshness import latest_values

_ROW = "query string, run_id string, batch_id bigint, reported_at string, input_rows bigint, name string, metric string, value bigint"


class ProgressLog(StreamingQueryListener):
    """Writes the observed metrics of the queries of a session to ``path``.

    ``names`` are the observations to keep, as given to ``observe``. Their metrics
    must be whole numbers.
    """

    def __init__(self, spark: SparkSession, path: str, names: list[str]):
        self.spark, self.path, self.names = spark, path, names

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        rows = [
            (str(progress.id), str(progress.runId), progress.batchId, progress.timestamp, progress.numInputRows, name, metric, int(value))
            for name, row in progress.observedMetrics.items()
            if name in self.names
            for metric, value in row.asDict().items()
            if value is not None
        ]
        if rows:
            self.spark.createDataFrame(rows, _ROW).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryTerminated(self, event) -> None:
        pass


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row per query, batch and metric: the last report."""
    rows = spark.read.parquet(path).withColumn("reported_at", F.to_timestamp("reported_at"))
    return latest_values(rows, ["reported_at", "run_id"], ["query", "batch_id", "name", "metric"])


def current_counts(spark: SparkSession, path: str) -> DataFrame:
    """Per query and observation: counts added up over all batches, the last run and the last batch."""
    rows = read_progress(spark, path)
    sums = rows.groupBy("query", "name", "metric").agg(F.sum("value").alias("value"))
    last = rows.groupBy("query", "name").agg(F.max("reported_at").alias("last_run"), F.max("batch_id").alias("last_batch"))
    return sums.join(last, ["query", "name"]).select("query", "name", "metric", "value", "last_run", "last_batch")
