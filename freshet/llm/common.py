"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from freshet.operators.joins import dimension
from freshet.session import shared_dir

ROWS_PER_CALL = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions_by_text(docs: DataFrame, text_col: str, characters: int) -> int:
    """Partitions of about so many characters, for all texts; no less than Spark is set to."""
    total = docs.agg(F.sum(F.length(text_col).cast("long"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // characters))


def keep(frame: DataFrame) -> DataFrame:
    """The rows, written once to the folder of ``spark.checkpoint.dir``; cuts the lineage."""
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(frame.sparkSession))
    return frame.checkpoint()


def least_hashed(rows: DataFrame, on: list[str], n: int, kind: str | None = None, among: DataFrame | None = None) -> DataFrame:
    """A bounded sample: the ``n`` distinct values of ``on`` with the least hashes (of each ``kind``), with the number of their rows as ``weight``.

    Rows that repeat come once, whatever their number, and a value is never too
    rare or too frequent to be taken. Only rows that have a partner in ``among`` count,
    if given. Ids and hashes are shuffled, texts only of the rows taken.
    """
    own = ["__kind", "__hash"]
    keyed = rows.withColumns({"__kind": F.col(kind) if kind else F.lit(0), "__hash": F.xxhash64(*on)})
    narrow = keyed if among is None else keyed.join(among, among.columns, "left_semi")
    counted = narrow.groupBy(*own).agg(F.count("*").alias("weight"))
    if kind:
        # Hashes are even, so the least n of N lie below 4 n / N of their range but for a chance beyond all bounds;
        # what a kind's task has to sort is so bounded, and kinds with few rows keep all.
        counted = keep(counted)
        share = F.lit(float(4 * n)) / F.count("*")
        bounds = counted.groupBy("__kind").agg(F.when(share < 1, share * 2.0**64 - 2.0**63).otherwise(2.0**64).alias("__bound"))
        near = dimension(bounds)
        counted = counted.join(near, "__kind").where(F.col("__hash").cast("double") <= F.col("__bound")).drop("__bound")
        place = F.row_number().over(Window.partitionBy("__kind").orderBy("__hash"))
        chosen = counted.withColumn("__place", place).where(F.col("__place") <= n).drop("__place")
    else:
        chosen = counted.orderBy("__hash").limit(n)
    # n rows of each kind, written once.
    taken = keyed.join(F.broadcast(keep(chosen)), own)
    return taken.groupBy(*own).agg(*(F.first(c).alias(c) for c in [*rows.columns, "weight"])).drop(*own)


def resampled(weights: np.ndarray, most: int) -> np.ndarray:
    """Positions of rows, each as often as its weight says, scaled down to ``most`` in all."""
    ends = np.cumsum(weights)
    many = min(most, int(ends[-1])) if len(ends) else 0
    return np.searchsorted(ends, (np.arange(many) + 0.5) * (ends[-1] / many)) if many else np.zeros(0, dtype=np.int64)


class Codes(dict):
    """Numbers of words; a word not seen before gets the next one and is listed in ``new``."""

    def __init__(self, known=()):
        super().__init__(known)
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = code = len(self)
        self.new.append(word)
        return code


def map_rows(frame: DataFrame, schema: StructType, start: Callable[[], Callable[..., dict]]) -> DataFrame:
    """Apply a function of column lists to slices of rows, in Arrow.

    ``start()`` runs once per task and returns the function; it gets one list
    per column of ``frame`` and returns a dict of lists (or arrays) by output
    column. No more than ``ROWS_PER_CALL`` rows are handled at a time.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_CALL):
                part = batch.slice(at, ROWS_PER_CALL)
                out = work(*(column.to_pylist() for column in part.columns))
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x := out[f.name], pa.Array) else pa.array(x, f.type) for f in arrow], schema=arrow
                )

    return frame.mapInArrow(run, schema)


def send(spark: SparkSession, value: Any) -> Broadcast:
    """Broadcast an object together with its class, so that executors need no copy of the package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(sent: Broadcast) -> Any:
    """The object of ``send``, made once per Python worker."""
    if not hasattr(sent, "received"):
        sent.received = cloudpickle.loads(sent.value)
    return sent.received


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def id_remainder(id_col: str, modulus: int) -> Column:
    """CRC-32 of the id as text, modulo; an id that is null counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus
