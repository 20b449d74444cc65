"""The latest-value table: one row per key, merged batch by batch, read as one version.

The rows lie in hash buckets, one file each. A batch reads and rewrites only the
buckets its keys fall into, under a folder of its own; all other buckets stay
where they are. What makes the batch visible is its version, a single small
file that names the folder of every bucket: a reader takes the newest version
and reads the folders it names, so it never sees half a batch, and no history
is folded. A batch that runs again before its version exists overwrites its own
folder; one whose version exists is skipped. ``prune`` removes the folders that
no kept version names.

There is one writer, the stream. The number of buckets is set by the first batch;
a bucket should stay of a size one task can rewrite.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.operators.freshness import KEY, latest_values

BUCKETS = 64

_VERSION = "version bigint, bucket int, buckets int, folder string"


def _versions(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(_VERSION).parquet(f"{path}/versions")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _newest(spark: SparkSession, path: str, many: int = 1) -> list[tuple[int, dict[int, tuple[str, int]]]]:
    """The newest versions, the last first: its number, and by bucket the folder and the number of buckets."""
    found = _versions(spark, path)
    if found is None:
        return []
    taken = [r[0] for r in found.select("version").distinct().orderBy(F.desc("version")).limit(many).collect()]
    out: dict[int, dict] = {v: {} for v in taken}
    for r in found.filter(F.col("version").isin(taken)).collect() if taken else ():
        out[r["version"]][r["bucket"]] = (r["folder"], r["buckets"])
    return list(out.items())


def _read(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    return spark.read.parquet(*[f"{path}/data/{f}" for f in sorted(folders)])


def _bucket(key: list[str], buckets: int):
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _publish(spark: SparkSession, path: str, version: int, folders: dict[int, tuple[str, int]]) -> None:
    """Write the version; its one file appears whole or not at all."""
    rows = [(version, bucket, buckets, folder) for bucket, (folder, buckets) in sorted(folders.items())]
    spark.createDataFrame(rows, _VERSION).coalesce(1).write.mode("overwrite").parquet(f"{path}/versions/batch={version}")


def merge_batch(
    rows: DataFrame,
    path: str,
    batch_id: int,
    order: list[str],
    key: list[str] = KEY,
    buckets: int = BUCKETS,
    on_change: Callable[[DataFrame], None] | None = None,
) -> bool:
    """Merge one batch; false if it was merged before.

    Of each key the row that is last by ``order`` stays; of equal ones that which
    is stored. For arrival order begin it with ``batch_id``, which every row gets.
    ``on_change`` is given (key, ``new``, ``old``) of the keys whose row changes,
    before the version appears, so it may run again and has to bear that.
    """
    spark = rows.sparkSession
    version, current = (_newest(spark, path) or [(-1, {})])[0]
    if version >= batch_id:
        return False
    if current:
        buckets = next(iter(current.values()))[1]
    batch = latest_values(rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")), order, key)
    batch = batch.withColumn("bucket", _bucket(key, buckets)).persist()
    met = None
    try:
        touched = [r[0] for r in batch.select("bucket").distinct().collect()]
        known = [current[b][0] for b in touched if b in current]
        values = [c for c in batch.columns if c not in (*key, "bucket")]
        new = batch.select(*key, "bucket", F.struct(*values).alias("new"))
        if known:
            stored = _read(spark, path, known)
            old = stored.select(*key, F.struct(*values).alias("old"))
        else:
            old = new.select(*key, F.col("new").alias("old")).limit(0)
        # Buckets of a batch and what is stored in them: one join, on the key, made once for the table and ``on_change``.
        met = new.join(old, key, "full_outer")
        if on_change is not None:
            met = met.persist()
        place = [F.struct(*[F.col(f"{side}.{c}") for c in order]) for side in ("new", "old")]
        changes = F.col("new").isNotNull() & (F.col("old").isNull() | (place[0] > place[1]))
        merged = met.select(*key, F.when(changes, F.col("new")).otherwise(F.col("old")).alias("last"))
        merged = merged.select(*key, "last.*").withColumn("bucket", _bucket(key, buckets))
        folder = f"batch={batch_id}"
        if touched:
            merged.repartition(len(touched), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/data/{folder}")
        if on_change is not None:
            on_change(met.filter(changes).select(*key, "new", "old"))
        if touched:
            _publish(spark, path, batch_id, current | {b: (f"{folder}/bucket={b}", buckets) for b in touched})
    finally:
        batch.unpersist()
        if met is not None:
            met.unpersist()
    return True


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest version: one row per key, and the batch that wrote it."""
    newest = _newest(spark, path)
    if not newest:
        raise ValueError(f"nothing has been merged into {path} yet")
    return _read(spark, path, [folder for folder, _ in newest[0][1].values()])


def live_files(spark: SparkSession, path: str) -> list[str]:
    return read_table(spark, path).inputFiles()


def prune(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Remove what the ``keep`` newest versions don't name; the number of folders removed.

    Readers that started from an older version lose their files, so ``keep`` has to
    cover the longest read.
    """
    kept = _newest(spark, path, keep)
    if not kept:
        return 0
    named = {folder for _, folders in kept for folder, _ in folders.values()}
    oldest, newest = kept[-1][0], kept[0][0]
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    removed = 0

    def names(folder: str) -> list[str]:
        files = hadoop(folder).getFileSystem(conf)
        return [s.getPath().getName() for s in files.listStatus(hadoop(folder)) if s.isDirectory()] if files.exists(hadoop(folder)) else []

    def remove(folder: str) -> None:
        nonlocal removed
        removed += bool(hadoop(folder).getFileSystem(conf).delete(hadoop(folder), True))

    # First the versions, then what they named.
    for batch in names(f"{path}/versions"):
        if int(batch[6:]) < oldest:
            remove(f"{path}/versions/{batch}")
    for batch in names(f"{path}/data"):
        if int(batch[6:]) > newest:
            continue  # a batch under way
        buckets = names(f"{path}/data/{batch}")
        dead = [b for b in buckets if f"{batch}/{b}" not in named]
        if len(dead) == len(buckets):
            remove(f"{path}/data/{batch}")
        else:
            for b in dead:
                remove(f"{path}/data/{batch}/{b}")
    return removed
