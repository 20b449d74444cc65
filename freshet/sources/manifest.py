"""Live folders of a date-partitioned lake, kept as a small versioned table.

Readers plan from the newest version and open only the folders it names. To
expire data, a version without the folders that are too old is written; it is
one small file, so readers see all of it or none. The folders themselves are
removed later, in a second phase, so that a reader that began with an earlier
version can finish.

Versions have one writer. A version holds one row for each folder of the lake,
which is bounded by the time the lake covers, not by its rows, and one row
without a folder, so that a version of an empty lake is one as well.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions.clock import instant
from freshet.operators.retention import retained

_SCHEMA = "version bigint, folder string, ends timestamp_ntz"


def _versions(spark: SparkSession, manifest: str) -> DataFrame:
    try:
        return spark.read.schema(_SCHEMA).parquet(manifest)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], _SCHEMA)
        raise


def _numbers(spark: SparkSession, manifest: str) -> list[int]:
    """All versions, the newest first."""
    return [r[0] for r in _versions(spark, manifest).select("version").distinct().orderBy(F.desc("version")).collect()]


def _publish(folders: DataFrame, manifest: str, version: int) -> int:
    mark = folders.sparkSession.createDataFrame([(None, None)], "folder string, ends timestamp_ntz")
    rows = folders.select("folder", "ends").unionByName(mark).select(F.lit(version).cast("bigint").alias("version"), "folder", "ends")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{manifest}/number={version}")
    return version


def live_folders(spark: SparkSession, manifest: str, version: int | None = None) -> DataFrame:
    """``folder, ends`` of a version, the newest by default; no rows if there is none."""
    if version is None:
        version = next(iter(_numbers(spark, manifest)), -1)
    return _versions(spark, manifest).filter((F.col("version") == version) & F.col("folder").isNotNull()).drop("version")


def register(spark: SparkSession, lake: str, manifest: str) -> int:
    """A version that names every folder now in the lake, by ``year=/month=/day=`` and, if it is there, ``hour=``."""
    root = "/" + lake.split("://", 1)[-1].lstrip("/").rstrip("/") + "/"
    found = sorted({f[f.index(root) + len(root) :].rsplit("/", 1)[0] for f in spark.read.parquet(lake).inputFiles()})
    part = {p: F.regexp_extract("folder", rf"(?:^|/){p}=(\d+)(?:/|$)", 1) for p in ("year", "month", "day", "hour")}
    hourly = part["hour"] != ""
    start = F.to_timestamp_ntz(
        F.concat_ws("-", part["year"], part["month"], part["day"], F.when(hourly, part["hour"]).otherwise("00")),
        F.lit("yyyy-MM-dd-HH"),
    )
    ends = start + F.when(hourly, F.expr("INTERVAL 1 HOUR")).otherwise(F.expr("INTERVAL 24 HOUR"))
    folders = spark.createDataFrame([(f,) for f in found], "folder string").withColumn("ends", ends)
    return _publish(folders, manifest, next(iter(_numbers(spark, manifest)), 0) + 1)


def expire(spark: SparkSession, manifest: str, as_of: str, keep_seconds: int) -> int:
    """A version without the folders all of whose rows are older than ``keep_seconds``; nothing is removed yet."""
    newest = next(iter(_numbers(spark, manifest)), None)
    if newest is None:
        raise ValueError(f"no version in {manifest} yet")
    border = instant(as_of, "timestamp_ntz") - F.make_dt_interval(secs=F.lit(keep_seconds))
    return _publish(live_folders(spark, manifest, newest).filter(F.col("ends") > border), manifest, newest + 1)


def read_live(spark: SparkSession, lake: str, manifest: str, version: int | None = None) -> DataFrame:
    """The rows of a version's folders, with the folder columns; the newest version by default."""
    folders = [r["folder"] for r in live_folders(spark, manifest, version).orderBy("folder").collect()]
    if not folders:
        return spark.read.parquet(lake).limit(0)
    return spark.read.option("basePath", lake).parquet(*[f"{lake}/{f}" for f in folders])


def read_retained(spark: SparkSession, lake: str, manifest: str, ts: str, as_of: str, keep_seconds: int) -> DataFrame:
    """``read_live`` without the rows of the border's folder that are too old."""
    return retained(read_live(spark, lake, manifest), ts, as_of, keep_seconds)


def remove_dead(spark: SparkSession, lake: str, manifest: str, keep: int = 2) -> int:
    """Remove what only versions before the ``keep`` newest name; the number of folders removed.

    Folders go before the versions that name them, so a run that fails is
    simply run again. A folder no version names yet is left alone.
    """
    numbers = _numbers(spark, manifest)
    kept, old = numbers[:keep], numbers[keep:]
    if not old:
        return 0
    named = _versions(spark, manifest)
    live = named.filter(F.col("version").isin(kept)).select("folder")
    dead = named.filter(F.col("version").isin(old)).select("folder").na.drop().distinct().join(live, "folder", "left_anti")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()

    def remove(folder: str) -> bool:
        return hadoop(folder).getFileSystem(conf).delete(hadoop(folder), True)

    removed = sum(remove(f"{lake}/{r['folder']}") for r in dead.collect())
    for version in old:
        remove(f"{manifest}/number={version}")
    return removed
