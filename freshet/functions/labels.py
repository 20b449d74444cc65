"""Words for ages and counts, as shown to people."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band limits.
GOOD_BELOW_MS, WARN_BELOW_MS = 5_000, 60_000
STALE_PERCENT_ERROR, STALE_PERCENT_WARN = 5, 1
STALE_COUNT_ERROR, STALE_COUNT_WARN = 100, 10


def freshness_label(age_ms: Column) -> Column:
    """``850ms``, ``12.5s``, ``7m`` or ``3.2h``."""
    return (
        F.when(age_ms < 1_000, F.concat(F.round(age_ms).cast("bigint").cast("string"), F.lit("ms")))
        .when(age_ms < 60_000, F.format_string("%.1fs", age_ms / 1_000.0))
        .when(age_ms < 3_600_000, F.concat(F.round(age_ms / 60_000.0).cast("bigint").cast("string"), F.lit("m")))
        .when(age_ms.isNotNull(), F.format_string("%.1fh", age_ms / 3_600_000.0))
    )


def freshness_band(age_ms: Column) -> Column:
    return (
        F.when(age_ms < GOOD_BELOW_MS, "good").when(age_ms < WARN_BELOW_MS, "warn").when(age_ms.isNotNull(), "stale")
    )


def stale_percent(stale: Column, total: Column) -> Column:
    """Percent with one digit, 0 for an empty group."""
    share = F.when(total > 0, stale.cast("decimal(18,0)") * 100 / total.cast("decimal(18,0)")).otherwise(F.lit(0))
    return F.round(share.cast("decimal(38,12)"), 1).cast("double")


def stale_percent_band(percent: Column) -> Column:
    return F.when(percent > STALE_PERCENT_ERROR, "error").when(percent > STALE_PERCENT_WARN, "warn").otherwise("ok")


def stale_count_band(stale: Column) -> Column:
    return F.when(stale > STALE_COUNT_ERROR, "error").when(stale > STALE_COUNT_WARN, "warn").otherwise("ok")
