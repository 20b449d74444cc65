"""Event time as microseconds since the epoch, for both timestamp types.

Columns without a zone are read as UTC (the session zone is pinned to UTC).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECOND = 1_000_000
DAY = 86_400


def micros(column: Column | str) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.unix_micros(value.cast("timestamp"))


def from_micros(value: Column, like: str = "timestamp") -> Column:
    return F.timestamp_micros(value).cast(like)


def type_of(df: DataFrame, column: str) -> str:
    """``timestamp`` or ``timestamp_ntz``: results come back in the input's type."""
    return df.schema[column].dataType.simpleString()


def instant(value: datetime | str, like: str = "timestamp") -> Column:
    """A literal moment, typed like the column it meets so the filter is pushed down."""
    return F.lit(str(value)).cast(like)


def age_seconds(ts: Column, as_of: Column) -> Column:
    return (micros(as_of) - micros(ts)) / F.lit(float(SECOND))


def floor_to(t: Column, width: int) -> Column:
    """Largest multiple of ``width`` not above ``t``, also before the epoch."""
    return t - F.pmod(t, F.lit(width))


def ceil_to(t: Column, width: int) -> Column:
    return t + F.pmod(-t, F.lit(width))
