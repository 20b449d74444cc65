"""Join helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_DIMENSION_ROWS = 50_000
MAX_DIMENSION_BYTES = 32 << 20


def dimension(df: DataFrame, max_rows: int = MAX_DIMENSION_ROWS, max_bytes: int = MAX_DIMENSION_BYTES) -> DataFrame:
    """Hint a broadcast, but only for a table whose size was looked at.

    The look stops after ``max_rows + 1`` rows. A larger table comes back
    without the hint and is shuffled, with adaptive execution splitting the
    partitions of hot keys.
    """
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    width = F.lit(8 * len(df.columns))
    for name in texts:
        width = width + F.coalesce(F.octet_length(F.col(name)), F.lit(0))
    rows, size = (
        df.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    )
    return F.broadcast(df) if rows <= max_rows and size <= max_bytes else df


def attach(rows: DataFrame, stats: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Give every row the statistics of its group, NULL keys included.

    ``stats`` has one row per key, so the number of rows stays. The many rows
    of a hot key are the stream side of the join, which adaptive execution
    may split; the one matching row is copied to each piece.
    """
    other = stats.select(
        *[F.col(k).alias(f"_{k}") for k in keys], *[c for c in stats.columns if c not in keys]
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return rows.join(other, same, how).drop(*[f"_{k}" for k in keys])
