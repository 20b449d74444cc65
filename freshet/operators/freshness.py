"""Latest values, their expiry, and how fresh they are.

The latest table has one row per ``entity_id, feature_name`` with
``value_raw, value_type, event_ts, source, schema_version, written_at,
expires_at``. Definitions are the registry: ``feature_name,
expected_freshness_seconds, is_active, ...``. The moment of a check is always
an argument.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.clock import SECOND, age_seconds, instant, micros, type_of
from freshet.functions.labels import (
    freshness_band,
    freshness_label,
    stale_count_band,
    stale_percent,
    stale_percent_band,
)
from freshet.operators.joins import dimension

# Fixed values of the expiry rule.
TTL_MULTIPLIER = 2
DEFAULT_FRESHNESS_SECONDS = 120

KEY = ["entity_id", "feature_name"]
ANSWER_FIELDS = ["value", "value_type", "timestamp", "age_seconds", "is_stale", "freshness_sla_seconds"]

# The registry is dealt over so many parts where entities meet all of it.
REGISTRY_PARTS = 16


def active(definitions: DataFrame) -> DataFrame:
    return definitions.filter("is_active")


def _slas(definitions: DataFrame) -> DataFrame:
    return active(definitions).select("feature_name", F.col("expected_freshness_seconds").alias("sla"))


def latest_values(events: DataFrame, order: list[str], key: list[str] = KEY) -> DataFrame:
    """The last event of each key in the order of the given columns.

    ``order=["event_ts", ...]`` keeps the newest; an arrival order such as an
    offset lets a late event overwrite a newer one. Combined map-side, so a
    key with many events sends one row per task.
    """
    rest = [c for c in events.columns if c not in key]
    last = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order]))
    return events.groupBy(*key).agg(last.alias("last")).select(*key, "last.*")


def with_expiry(
    events: DataFrame, definitions: DataFrame, written_at: str = "written_at", multiplier: int = TTL_MULTIPLIER
) -> DataFrame:
    """Adds ``ttl_seconds`` and ``expires_at``.

    A value lives twice as long as its feature may age; features that are not
    registered get a default.
    """
    ttl = F.coalesce(F.col("sla"), F.lit(DEFAULT_FRESHNESS_SECONDS)).cast("bigint") * multiplier
    like = type_of(events, written_at)
    return (
        events.join(dimension(_slas(definitions)), "feature_name", "left")
        .withColumn("ttl_seconds", ttl)
        .withColumn(
            "expires_at", F.timestamp_micros(micros(written_at) + F.col("ttl_seconds") * SECOND).cast(like)
        )
        .select(*events.columns, "ttl_seconds", "expires_at")
    )


def visible(latest: DataFrame, as_of: str) -> DataFrame:
    """Rows that have not expired at ``as_of``."""
    return latest.filter(F.col("expires_at") > instant(as_of, type_of(latest, "expires_at")))


def _is_stale(sla: Column, age: Column) -> Column:
    """Nothing stored counts as stale; a value whose feature is not registered has nothing to violate."""
    missing = F.col("event_ts").isNull() & F.col("value_raw").isNull()
    return F.when(missing, F.lit(True)).otherwise(F.coalesce(age > sla, F.lit(False)))


def _freshness(sla: Column, age: Column) -> list[Column]:
    """Output columns of a looked-up value; the comparison uses the unrounded age."""
    return [
        F.col("value_raw").alias("value"),
        F.col("value_type"),
        F.col("event_ts").alias("timestamp"),
        F.round(age, 2).alias("age_seconds"),
        _is_stale(sla, age).alias("is_stale"),
        sla.alias("freshness_sla_seconds"),
    ]


def _age(latest: DataFrame, as_of: str) -> Column:
    return age_seconds(F.col("event_ts"), instant(as_of, type_of(latest, "event_ts")))


def entity_freshness(entities: DataFrame, definitions: DataFrame, latest: DataFrame, as_of: str) -> DataFrame:
    """Every active feature of every given entity, stored or not.

    ``entities`` has ``entity_id``: those that are asked for, since the result
    has a row for each of them and each definition. The registry is dealt over
    ``REGISTRY_PARTS`` parts and each entity meets each part, so no row holds
    the whole registry; it is broadcast if its checked size allows. The pairs
    then meet the latest table on its key. For totals alone see ``entity_totals``.
    """
    part = F.pmod(F.xxhash64("feature_name"), F.lit(REGISTRY_PARTS)).cast("int")
    registry = dimension(_slas(definitions).withColumn("part", part))
    parts = F.explode(F.sequence(F.lit(0), F.lit(REGISTRY_PARTS - 1))).alias("part")
    wanted = entities.select("entity_id").distinct().select("entity_id", parts).join(registry, "part")
    wanted = wanted.select("entity_id", "feature_name", "sla")
    stored = latest.select(*KEY, "value_raw", "value_type", "event_ts")
    return wanted.join(stored, KEY, "left").select(*KEY, *_freshness(F.col("sla"), _age(latest, as_of)))


def requested_features(requests: DataFrame, definitions: DataFrame, latest: DataFrame, as_of: str) -> DataFrame:
    """One answer per requested (entity_id, feature_name), registered or not."""
    stored = latest.select(*KEY, "value_raw", "value_type", "event_ts")
    return (
        requests.select(*KEY)
        .join(stored, KEY, "left")
        .join(dimension(_slas(definitions)), "feature_name", "left")
        .select(*KEY, *_freshness(F.col("sla"), _age(latest, as_of)))
    )


def entity_totals(entities: DataFrame, definitions: DataFrame, latest: DataFrame, as_of: str) -> DataFrame:
    """``total_features, stale_features`` of each given entity, by counting.

    All active definitions count; stale are those without a fresh stored
    value. Only stored values are read, no pairs are made.
    """
    registry = _slas(definitions)
    total = registry.agg(F.count("*").alias("n")).scalar()
    fresh = (
        latest.join(dimension(registry), "feature_name")
        .select("entity_id", _is_stale(F.col("sla"), _age(latest, as_of)).alias("is_stale"))
        .groupBy("entity_id")
        .agg(F.count_if(~F.col("is_stale")).alias("fresh"))
    )
    return (
        entities.select("entity_id")
        .distinct()
        .join(fresh, "entity_id", "left")
        .select("entity_id", total.alias("total_features"), (total - F.coalesce("fresh", F.lit(0))).alias("stale_features"))
    )


def entity_summary(freshness: DataFrame, with_features: bool = False) -> DataFrame:
    """Totals per entity; optionally a map from feature to its row.

    The map holds one entry per active definition, so its size is that of the
    registry.
    """
    columns = [
        F.count("*").alias("total_features"),
        F.count_if("is_stale").alias("stale_features"),
    ]
    if with_features:
        row = F.struct(*ANSWER_FIELDS)
        columns.append(
            F.map_from_entries(F.collect_list(F.struct(F.col("feature_name"), row.alias("row")))).alias("features")
        )
    return freshness.groupBy("entity_id").agg(*columns)


def monitored(latest: DataFrame, definitions: DataFrame, as_of: str, include_expired: bool = False) -> DataFrame:
    """Stored values of active features with ``age_seconds`` and ``is_stale``.

    A row whose time could not be read is counted but is never stale.
    """
    rows = latest if include_expired or "expires_at" not in latest.columns else visible(latest, as_of)
    age = _age(latest, as_of)
    return rows.join(dimension(_slas(definitions)), "feature_name").select(
        *KEY, "event_ts", age.alias("age_seconds"), "sla", F.coalesce(age > F.col("sla"), F.lit(False)).alias("is_stale")
    )


def sla_sweep(checked: DataFrame) -> DataFrame:
    """Stale and total count per feature."""
    return checked.groupBy("feature_name").agg(
        F.first("sla").alias("sla_seconds"),
        F.count_if("is_stale").alias("stale_count"),
        F.count("*").alias("total_count"),
    )


def stale_entities(checked: DataFrame) -> DataFrame:
    """The entities behind the stale counts, as rows: their number has no bound."""
    return checked.filter("is_stale").select("feature_name", "entity_id", "age_seconds")


def health(sweep: DataFrame) -> DataFrame:
    """One row: degraded as soon as anything is stale."""
    totals = sweep.agg(
        F.coalesce(F.sum("stale_count"), F.lit(0)).alias("stale_feature_count"),
        F.coalesce(F.sum("total_count"), F.lit(0)).alias("total_monitored_features"),
    )
    status = F.when(F.col("stale_feature_count") > 0, "degraded").otherwise("healthy")
    return totals.select(status.alias("status"), "stale_feature_count", "total_monitored_features")


def stale_bands(sweep: DataFrame) -> DataFrame:
    """Sweep rows with stale percent and the bands of percent and count."""
    percent = stale_percent(F.col("stale_count"), F.col("total_count"))
    return sweep.select(
        "feature_name",
        "stale_count",
        "total_count",
        percent.alias("stale_percent"),
        stale_percent_band(percent).alias("percent_band"),
        stale_count_band(F.col("stale_count")).alias("count_band"),
    )


def feature_group_rollup(checked: DataFrame, group: Column, tags: dict[str, Column] | None = None) -> DataFrame:
    """Per feature group: count, mean age, stale count and ratio, last write."""
    age_us = F.round(F.col("age_seconds") * SECOND).cast("bigint")
    grouped = checked.groupBy(group.alias("feature_group")).agg(
        F.count("*").alias("feature_count"),
        (F.sum(age_us.cast("decimal(19,0)")).cast("double") / F.count(age_us) / 1000.0).alias("avg_freshness_ms"),
        F.count_if("is_stale").alias("stale_features_count"),
        F.max("event_ts").alias("last_materialization_time"),
        *[c.alias(n) for n, c in (tags or {}).items()],
    )
    mean_ms = F.col("avg_freshness_ms")
    return grouped.select(
        "*",
        F.round(F.col("stale_features_count") / F.col("feature_count"), 6).alias("stale_ratio"),
        freshness_label(mean_ms).alias("freshness_label"),
        freshness_band(mean_ms).alias("freshness_band"),
    )


def sweep_log_rows(sweep: DataFrame, swept_at: str) -> DataFrame:
    """Sweep results stamped for the sweep log."""
    return sweep.select(F.lit(str(swept_at)).cast("timestamp").alias("swept_at"), *sweep.columns)


def total_violations(sweep_log: DataFrame) -> DataFrame:
    """Violations added up over all sweeps, and the newest sweep of each feature."""
    return sweep_log.groupBy("feature_name").agg(
        F.sum("stale_count").alias("total_violations"),
        F.count("*").alias("sweeps"),
        F.max("swept_at").alias("last_run"),
    )


def processing_counts(parsed: DataFrame) -> DataFrame:
    """Processed and failed messages."""
    return parsed.agg(
        F.count_if(F.col("error").isNull()).alias("messages_processed"),
        F.count_if(F.col("error").isNotNull()).alias("messages_failed"),
    )
