"""Every operator as a query over the sample tables.

``QUERIES`` maps a name to a function of (session, table folder). The twins in
``freshet.plans.oracle`` state the same results in plain SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.functions import messages as msg
from freshet.operators import (
    due,
    features,
    freshness,
    lookup,
    moments,
    point_in_time,
    probes,
    registry,
    retention,
    sessions,
    snapshots,
    trailing,
    windows,
)
from freshet.plans.materialize import feature_view, materialize_features, materialize_vectors
from freshet.session import configure, shared_dir
from freshet.sources import manifest, sinks
from freshet.sources.tables import file_states, orders_by_customer, read_table, transactions, window_events
from freshet.streaming import ingest, inputs, lake, latest_table, progress, sweeps
from freshet.streaming import state
from freshet.streaming import windows as stream_windows

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2024-01-31 00:00:00"
REFERENCE_DATE = "2024-01-31"
SPLIT = "2024-01-16 00:00:00"
SESSION_GAP_SECONDS = 1800

# the event types as features, with limits that suit a month of data
EVENT_DEFINITIONS = [
    ("click", 1, True),
    ("view", 2, True),
    ("purchase", 3, True),
    ("signup", 4, True),
    ("error", 5, False),
]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, root: str) -> DataFrame:
        return function(configure(spark), root)

    QUERIES[function.__name__] = run
    return function


def _events(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "events")


def _txns(spark: SparkSession, root: str) -> DataFrame:
    return transactions(_events(spark, root))


def _window_events(spark: SparkSession, root: str) -> DataFrame:
    return window_events(_events(spark, root))


def _orders(spark: SparkSession, root: str) -> DataFrame:
    return orders_by_customer(read_table(spark, root, "orders"))


def _wide(spark: SparkSession, root: str) -> DataFrame:
    return features.wide_features(_txns(spark, root), REFERENCE_DATE)


_stored: dict[tuple, str] = {}


def _store(spark: SparkSession, root: str) -> str:
    """Folder of the feature table and the per-user table made from the events under ``root``.

    Both are written once per application and state of the input files (name,
    length, time of change); the lookups read what is stored.
    """
    key = (spark.sparkContext.applicationId, *file_states(_events(spark, root)))
    if key not in _stored:
        folder = _scratch(spark)
        materialize_features(_txns(spark, root), f"{folder}/features", REFERENCE_DATE)
        materialize_vectors(spark.read.parquet(f"{folder}/features"), f"{folder}/vectors")
        _stored[key] = folder
    return _stored[key]


def _feature_table(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{_store(spark, root)}/features")


def _vector_table(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{_store(spark, root)}/vectors")


def _shown(vectors: DataFrame) -> DataFrame:
    return _rounded(vectors, *[m for m, how in lookup.METRIC_AGGREGATES.items() if how == "avg"])


def _rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/query-{uuid.uuid4().hex}"


# --- spend features -------------------------------------------------------------


@query
def rolling_7d_spend_avg(spark, root):
    return features.rolling_spend_avg(_txns(spark, root))


@query
def category_counts(spark, root):
    return features.category_counts(_txns(spark, root))


@query
def top_merchant_category(spark, root):
    return features.top_merchant_category(_txns(spark, root))


@query
def anomaly_score(spark, root):
    return features.anomaly_scores(_txns(spark, root))


@query
def rfm(spark, root):
    return features.rfm(_txns(spark, root), REFERENCE_DATE)


@query
def user_features_wide(spark, root):
    return _wide(spark, root)


# --- declared features ----------------------------------------------------------


@query
def rolling_7d_spend(spark, root):
    events = _events(spark, root).select("event_id", "user_id", "ts", "value")
    return trailing.trailing_totals(events, "user_id", "ts", 7 * 86_400, "value").select(
        "event_id", "user_id", F.col("trailing_sum").alias("rolling_7d_spend")
    )


@query
def order_count_24h(spark, root):
    return trailing.trailing_totals(_orders(spark, root), "entity_id", "ts", 86_400, bucket_seconds=30 * 86_400).select(
        "order_id", "entity_id", F.col("trailing_count").alias("order_count_24h")
    )


@query
def event_count_24h(spark, root):
    events = _events(spark, root).select("event_id", "user_id", "ts")
    return trailing.trailing_totals(events, "user_id", "ts", 86_400).select(
        "event_id", "user_id", F.col("trailing_count").alias("event_count_24h")
    )


@query
def avg_basket_size(spark, root):
    orders = _orders(spark, root)
    return trailing.last_rows_mean(orders, "entity_id", "ts", "order_id", "amount", 30, bucket_seconds=365 * 86_400).select(
        "order_id", "entity_id", F.col("trailing_mean").alias("avg_basket_size")
    )


@query
def avg_event_value_30(spark, root):
    events = _events(spark, root).select("event_id", "user_id", "ts", "value")
    return trailing.last_rows_mean(events, "user_id", "ts", "event_id", "value", 30).select(
        "event_id", "user_id", F.col("trailing_mean").alias("avg_event_value_30")
    )


@query
def avg_basket_size_now(spark, root):
    return trailing.latest_rows_mean(_orders(spark, root), "entity_id", "ts", "order_id", "amount", 30).select(
        "entity_id", F.col("latest_mean").alias("avg_basket_size"), F.col("rows_used").alias("orders_used")
    )


@query
def days_since_last_order(spark, root):
    return trailing.days_since_last(_orders(spark, root), "entity_id", "ts", "2001-12-31 12:00:00").select(
        "entity_id", F.col("days_since_last").alias("days_since_last_order")
    )


@query
def preferred_category(spark, root):
    """Most frequently bought part brand per customer."""
    lines = read_table(spark, root, "lineitem").select("l_orderkey", "l_partkey")
    orders = read_table(spark, root, "orders").select("o_orderkey", "o_custkey")
    parts = read_table(spark, root, "part").select("p_partkey", "p_brand")
    bought = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("o_custkey").alias("user_id"), F.col("p_brand").alias("merchant_category"))
    )
    return features.top_merchant_category(bought).select(
        F.col("user_id").alias("customer_id"),
        F.col("top_merchant_category").alias("preferred_category"),
        F.col("merchant_category_count").alias("lines_bought"),
    )


@query
def sessions_30min(spark, root):
    return sessions.sessions(_events(spark, root), "user_id", "ts", SESSION_GAP_SECONDS)


@query
def session_count_1h(spark, root):
    return sessions.session_counts(_events(spark, root), "user_id", "ts", SESSION_GAP_SECONDS)


@query
def session_count_last_day(spark, root):
    return sessions.active_sessions(_events(spark, root), "user_id", "ts", SESSION_GAP_SECONDS, AS_OF, 86_400)


# --- lookups --------------------------------------------------------------------


@query
def user_feature_vector(spark, root):
    return _shown(_vector_table(spark, root))


@query
def user_feature_vector_latest(spark, root):
    return lookup.user_feature_vectors(_feature_table(spark, root), latest_only=True, digits=6)


@query
def single_user_vector(spark, root):
    return lookup.user_feature_vectors(_feature_table(spark, root), user_id=7, digits=6)


def _top_k(spark: SparkSession, root: str, metric: str, ascending: bool) -> DataFrame:
    return lookup.top_k_vectors(_vector_table(configure(spark), root), 10, metric, ascending, digits=6)


for _metric in lookup.METRIC_AGGREGATES:
    for _ascending in (True, False):
        QUERIES[f"topk_{_metric}_{'asc' if _ascending else 'desc'}"] = partial(
            _top_k, metric=_metric, ascending=_ascending
        )


@query
def drift_summary(spark, root):
    return _rounded(lookup.drift_summary(_feature_table(spark, root)), "mean", "std", "min", "max")


@query
def feature_row_count(spark, root):
    return lookup.row_count(_feature_table(spark, root))


@query
def partition_rows(spark, root):
    return lookup.rows_per_date(_txns(spark, root))


@query
def recent_events(spark, root):
    return lookup.most_recent(_events(spark, root), "ts", "event_id")


@query
def feature_view_sql(spark, root):
    """The stored table as a view, asked in SQL."""
    name = f"features_{uuid.uuid4().hex}"
    feature_view(spark, f"{_store(spark, root)}/features", name)
    return spark.sql(
        "SELECT event_date, top_merchant_category, count(*) AS row_count, count(DISTINCT user_id) AS users, "
        f"max(frequency) AS most_frequent FROM {name} WHERE event_date >= DATE '2024-01-20' "
        "GROUP BY event_date, top_merchant_category"
    )


@query
def feature_table_roundtrip(spark, root):
    """Written by date and read back."""
    path = f"{_scratch(spark)}/features"
    materialize_features(_txns(spark, root), path, REFERENCE_DATE)
    return spark.read.parquet(path).select(*features.WIDE_COLUMNS)


# --- windows --------------------------------------------------------------------


@query
def tumbling_1min(spark, root):
    return windows.tumbling(_window_events(spark, root), 60)


@query
def tumbling_5min(spark, root):
    return windows.tumbling(_window_events(spark, root), 300)


@query
def tumbling_1hr(spark, root):
    return windows.tumbling(_window_events(spark, root), 3600)


@query
def sliding_5min_1min(spark, root):
    return windows.sliding_series(_window_events(spark, root))


@query
def sliding_1hr_7min(spark, root):
    """A window that is no multiple of its step."""
    return windows.sliding_series(_window_events(spark, root), 3600, 420)


@query
def sliding_tail(spark, root):
    """What a buffer of the last day would give."""
    return windows.sliding_series(_window_events(spark, root), 3600, 600, tail_seconds=86_400)


@query
def sliding_point(spark, root):
    return windows.sliding_at(_window_events(spark, root), "2024-01-15 12:00:00", 3600)


@query
def sliding_latest(spark, root):
    return windows.sliding_at_latest(_window_events(spark, root), 3600)


@query
def sliding_probes(spark, root):
    """The last hour as seen at every event."""
    asked = _events(spark, root).select("event_id", F.col("ts").alias("at"))
    return probes.sliding_probes(_window_events(spark, root), asked, 3600)


@query
def tumbling_ordered(spark, root):
    return windows.in_order(windows.tumbling(_window_events(spark, root), 300))


@query
def window_multi(spark, root):
    return windows.multi_resolution(_window_events(spark, root))


# --- messages and freshness -------------------------------------------------------


def _definitions(spark: SparkSession) -> DataFrame:
    rows = [(name, f"{name} events", "analytics", days * 86_400, "float", on) for name, days, on in EVENT_DEFINITIONS]
    return spark.createDataFrame(
        rows,
        "feature_name string, description string, owner string, expected_freshness_seconds int, "
        "value_type string, is_active boolean",
    )


def _entity(user: str = "user_id") -> Column:
    # Padded only if shorter: lpad would also cut longer ids.
    number = F.col(user).cast("string")
    return F.concat(F.lit("customer_"), F.when(F.length(number) < 5, F.lpad(number, 5, "0")).otherwise(number))


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def _message_stream(events: DataFrame) -> DataFrame:
    """Events as JSON messages; the property ``k`` of an event decides how a message is broken.

    The value is a number, a text or a truth value, depending on the type.
    """
    events = events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    k = F.col("k")
    value = (
        F.when(F.col("event_type") == "view", F.floor("value").cast("string"))
        .when(F.col("event_type") == "signup", F.concat(F.lit('"v'), F.col("value").cast("string"), F.lit('"')))
        .when(F.col("event_type") == "error", (F.col("value") > 50).cast("string"))
        .otherwise(F.col("value").cast("string"))
    )
    name = F.when(k == 0, "bad-name").when(k == 1, F.upper("event_type")).otherwise(F.col("event_type"))
    entity = F.when(k == 2, "   ").otherwise(_entity())
    stamp = F.when(k == 3, "yesterday").otherwise(_iso(F.col("ts")))
    whole = F.concat(
        F.lit('{"entity_id":"'), entity, F.lit('","feature_name":"'), name, F.lit('","value":'),
        F.when(k == 4, "null").otherwise(value), F.lit(',"timestamp":"'), stamp, F.lit('","source":"web"}'),
    )
    return events.withColumn("whole", whole).select(
        F.when(k == 5, F.substring("whole", 1, 40)).when(k == 6, "[]").otherwise(F.col("whole")).alias("value"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("received_at"),
    )


def _parsed(spark: SparkSession, root: str) -> DataFrame:
    return msg.parse_messages(_message_stream(_events(spark, root)), received_at="received_at")


def _feature_events(spark: SparkSession, root: str) -> DataFrame:
    """Events as already checked feature events; written when they happened."""
    return _as_feature_events(_events(spark, root))


def _as_feature_events(events: DataFrame) -> DataFrame:
    return events.select(
        _entity().alias("entity_id"),
        F.col("event_type").alias("feature_name"),
        F.col("value").cast("string").alias("value_raw"),
        F.lit("float").alias("value_type"),
        F.col("ts").alias("event_ts"),
        F.lit("web").alias("source"),
        F.lit("1.0").alias("schema_version"),
        F.col("ts").alias("written_at"),
        F.col("event_id").alias("offset"),
    )


def _latest(spark: SparkSession, root: str) -> DataFrame:
    last = freshness.latest_values(_feature_events(spark, root), ["event_ts", "offset"])
    return freshness.with_expiry(last, _definitions(spark))


def _checked(spark: SparkSession, root: str) -> DataFrame:
    return freshness.monitored(_latest(spark, root), _definitions(spark), AS_OF, include_expired=True)


def _sweep(spark: SparkSession, root: str) -> DataFrame:
    return freshness.sla_sweep(_checked(spark, root))


def _number_and_text(df: DataFrame) -> DataFrame:
    """Numbers as doubles, so that their spelling does not matter."""
    number = F.when(F.col("value_type").isin("int", "float"), F.col("value_raw").cast("double"))
    text = F.when(F.col("value_type").isin("str", "bool"), F.col("value_raw"))
    return df.select(
        *[c for c in df.columns if c not in ("value_raw", "metadata", "received_at")],
        number.alias("value_number"),
        text.alias("value_text"),
    )


@query
def event_validation(spark, root):
    parsed = _number_and_text(msg.valid_events(_parsed(spark, root)).drop("value"))
    return parsed.withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


@query
def dlq_split(spark, root):
    return msg.dead_letters(_parsed(spark, root)).drop("received_at")


@query
def processing_counts(spark, root):
    return freshness.processing_counts(_parsed(spark, root))


@query
def published_messages(spark, root):
    """Keyed messages read back: key, entity and value survive the trip."""
    sent = msg.to_messages(_feature_events(spark, root).withColumn("metadata", F.lit(None).cast("map<string,string>")))
    back = msg.valid_events(msg.parse_messages(sent))
    return _number_and_text(back.drop("value")).withColumn("event_ts", F.col("event_ts").cast("timestamp_ntz"))


@query
def key_validation(spark, root):
    entity = F.concat(_entity(), F.when(F.col("event_type") == "error", ":x").otherwise(""))
    name = F.when(F.col("event_type") == "signup", "Sign-Up").otherwise(F.col("event_type"))
    return _events(spark, root).select("event_id", msg.lookup_key_error(entity, name).alias("key_error"))


@query
def latest_value(spark, root):
    return freshness.latest_values(_feature_events(spark, root), ["event_ts", "offset"])


@query
def latest_value_arrival(spark, root):
    """Arrival order: here by value, so older events overwrite newer ones."""
    arrived = _feature_events(spark, root).withColumn("arrival", F.col("value_raw").cast("double"))
    return freshness.latest_values(arrived, ["arrival", "offset"])


@query
def value_expiry(spark, root):
    return freshness.with_expiry(_feature_events(spark, root), _definitions(spark)).select(
        "offset", "feature_name", "ttl_seconds", "expires_at"
    )


@query
def ttl_visible(spark, root):
    return freshness.visible(_latest(spark, root), AS_OF).select("entity_id", "feature_name", "event_ts", "expires_at")


@query
def entity_freshness(spark, root):
    latest = _latest(spark, root)
    return freshness.entity_freshness(latest, _definitions(spark), latest, AS_OF)


@query
def entity_summary(spark, root):
    latest = _latest(spark, root)
    return freshness.entity_totals(latest.select("entity_id"), _definitions(spark), latest, AS_OF)


@query
def entity_feature_maps(spark, root):
    latest = _latest(spark, root)
    rows = freshness.entity_freshness(latest, _definitions(spark), latest, AS_OF)
    nested = freshness.entity_summary(rows, with_features=True)
    columns = ["entity_id", F.size("features").alias("features")]
    for name in [name for name, _, on in EVENT_DEFINITIONS if on]:
        entry = F.element_at("features", F.lit(name))
        columns += [entry[field].alias(f"{name}_{field}") for field in freshness.ANSWER_FIELDS]
    return nested.select(*columns)


@query
def single_feature(spark, root):
    """One request per customer and part size: some stored, some registered, some neither."""
    customers = read_table(spark, root, "customer").select(
        _entity("c_custkey").alias("entity_id"), F.lower("c_mktsegment").alias("segment")
    )
    asked = F.when(F.col("segment") == "building", "error").when(F.col("segment") == "machinery", "unknown")
    requests = customers.select("entity_id", asked.otherwise(F.lit("click")).alias("feature_name"))
    return freshness.requested_features(requests, _definitions(spark), _latest(spark, root), AS_OF)


@query
def sla_sweep(spark, root):
    return _sweep(spark, root)


@query
def sla_sweep_visible(spark, root):
    return freshness.sla_sweep(freshness.monitored(_latest(spark, root), _definitions(spark), AS_OF))


@query
def stale_entities(spark, root):
    return freshness.stale_entities(_checked(spark, root))


@query
def health(spark, root):
    return freshness.health(_sweep(spark, root))


@query
def stale_bands(spark, root):
    return freshness.stale_bands(_sweep(spark, root))


@query
def feature_group_rollup(spark, root):
    group = F.when(F.col("feature_name").isin("click", "view"), "browse").otherwise("convert")
    return freshness.feature_group_rollup(_checked(spark, root), group)


@query
def sla_violations_total(spark, root):
    """Four sweeps, each over what was known at its time."""
    definitions = _definitions(spark)

    def at(moment: str) -> DataFrame:
        known = _feature_events(spark, root).filter(F.col("event_ts") <= F.lit(moment).cast("timestamp_ntz"))
        latest = freshness.with_expiry(freshness.latest_values(known, ["event_ts", "offset"]), definitions)
        checked = freshness.monitored(latest, definitions, moment)
        return freshness.sweep_log_rows(freshness.sla_sweep(checked), moment)

    moments = ["2024-01-08 00:00:00", "2024-01-15 00:00:00", "2024-01-22 00:00:00", AS_OF]
    log = reduce(DataFrame.unionByName, [at(m) for m in moments])
    return freshness.total_violations(log).withColumn("last_run", F.col("last_run").cast("timestamp_ntz"))


@query
def sla_violations_swept(spark, root):
    """The same four sweeps as jobs that keep a log; one of them runs twice and counts once."""
    definitions, log = _definitions(spark), f"{_scratch(spark)}/sweeps"
    for moment in ["2024-01-08 00:00:00", "2024-01-15 00:00:00", "2024-01-15 00:00:00", "2024-01-22 00:00:00", AS_OF]:
        known = _feature_events(spark, root).filter(F.col("event_ts") <= F.lit(moment).cast("timestamp_ntz"))
        latest = freshness.with_expiry(freshness.latest_values(known, ["event_ts", "offset"]), definitions)
        sweeps.sweep_once(latest, definitions, moment, log)
    totals = freshness.total_violations(spark.read.parquet(log))
    return totals.withColumn("last_run", F.col("last_run").cast("timestamp_ntz"))


@query
def sweep_incremental(spark, root):
    """Batches merged into the latest-value table, and sweeps that read what falls due since the last one.

    The last two sweeps come without a batch: only time has passed. The events are read
    once, and reduced to the last row of each key and batch before they are merged.
    """
    folder, definitions = _scratch(spark), _definitions(spark)
    table, entries, log = (f"{folder}/{name}" for name in ("latest", "due", "log"))
    arrivals = ["2024-01-08 00:00:00", "2024-01-15 00:00:00", "2024-01-22 00:00:00", AS_OF]
    batch_of = F.coalesce(*[F.when(F.col("ts") <= F.lit(m).cast("timestamp_ntz"), F.lit(n)) for n, m in enumerate(arrivals)])
    known = _events(spark, root).select("user_id", "event_type", "value", "ts", "event_id", batch_of.alias("arrival")).filter("arrival IS NOT NULL")
    last = freshness.latest_values(known, ["ts", "event_id"], ["arrival", "user_id", "event_type"])
    last.write.partitionBy("arrival").parquet(f"{folder}/arrivals")
    landed = spark.read.schema(last.schema).parquet(f"{folder}/arrivals")
    for batch_id, moment in enumerate(arrivals):
        arrived = _as_feature_events(landed.filter(F.col("arrival") == batch_id))

        def index(changes: DataFrame, batch_id: int = batch_id, moment: str = moment) -> None:
            due.write_entries(due.due_entries(changes, definitions, moment), entries, batch_id, slice_seconds=86_400)

        rows = freshness.with_expiry(arrived, definitions)
        latest_table.merge_batch(rows, table, batch_id, ["event_ts", "offset"], buckets=8, on_change=index)
        sweeps.sweep_due(spark, entries, definitions, moment, log, slice_seconds=86_400)
    for moment in ("2024-02-01 12:00:00", "2024-02-03 00:00:00"):
        sweeps.sweep_due(spark, entries, definitions, moment, log, slice_seconds=86_400)
    swept = spark.read.parquet(log).drop("sweep_id")
    return swept.withColumn("swept_at", F.col("swept_at").cast("timestamp_ntz"))


# --- training rows ------------------------------------------------------------------


def _labels(spark: SparkSession, root: str) -> DataFrame:
    return _events(spark, root).filter(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")


@query
def point_in_time_latest(spark, root):
    known = _events(spark, root).filter(F.col("event_type") != "purchase")
    return point_in_time.point_in_time(_labels(spark, root), known, "user_id", "ts", "event_id", "value")


@query
def point_in_time_features(spark, root):
    return point_in_time.point_in_time(
        _labels(spark, root), _events(spark, root), "user_id", "ts", "event_id", "value",
        feature_name="event_type", names=[name for name, *_ in EVENT_DEFINITIONS],
    )


# --- snapshots, registry, retention ----------------------------------------------------


def _halves(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    events = _events(spark, root)
    split = F.lit(SPLIT).cast("timestamp_ntz")
    return events.filter(F.col("ts") < split), events.filter(F.col("ts") >= split)


@query
def snapshot_profile(spark, root):
    return _rounded(snapshots.profile(_events(spark, root), scale=2), "std")


def _stored_moments(spark: SparkSession, root: str) -> str:
    """Moments of the events, a snapshot per day."""
    path = f"{_scratch(spark)}/moments"
    daily = _events(spark, root).withColumn("snapshot_id", F.date_format("ts", "yyyyMMdd"))
    moments.moments(daily, ["snapshot_id"], scale=2).write.partitionBy("snapshot_id").parquet(path)
    return path


@query
def snapshot_profile_merged(spark, root):
    """The profile of all days from their stored moments."""
    found = moments.read_moments(spark, _stored_moments(spark, root))
    return _rounded(moments.merged_profile(found, scale=2), "std")


@query
def snapshot_drift_merged(spark, root):
    found = moments.read_moments(spark, _stored_moments(spark, root))
    return _rounded(moments.merged_drift(found, "value", scale=2), "std")


@query
def snapshot_diff(spark, root):
    a, b = _halves(spark, root)
    diff = snapshots.profile_diff(snapshots.profile(a, scale=2), snapshots.profile(b.drop("user_id"), scale=2))
    return _rounded(diff, *[c for c in diff.columns if c != "feature"], digits=4)


@query
def snapshot_drift(spark, root):
    daily = _events(spark, root).withColumn("snapshot_id", F.date_format("ts", "yyyyMMdd"))
    return _rounded(snapshots.drift_series(daily, "snapshot_id", "value", scale=2), "std")


def _snapshot_log(spark: SparkSession, root: str) -> DataFrame:
    """A commit per day; a day with less turnover than the one before it is rolled back."""
    daily = (
        _events(spark, root)
        .groupBy(F.to_date("ts").alias("d"))
        .agg(F.count("*").alias("row_count"), F.sum(F.col("value").cast("decimal(18,2)")).alias("turnover"))
    )
    before = daily.select(F.date_add("d", 1).alias("d"), F.col("turnover").alias("turnover_before"))
    name = F.concat(F.lit("snap_"), F.date_format("d", "yyyyMMdd"))
    commits = daily.select(
        F.lit("commit").alias("event_type"),
        F.concat(F.col("d").cast("string"), F.lit("T12")).alias("event_at"),
        name.alias("snapshot_id"),
        "row_count",
    )
    rollbacks = (
        daily.join(before, "d")
        .filter(F.col("turnover") < F.col("turnover_before"))
        .select(
            F.lit("rollback").alias("event_type"),
            F.concat(F.col("d").cast("string"), F.lit("T18")).alias("event_at"),
            F.concat(F.lit("snap_"), F.date_format(F.date_sub("d", 1), "yyyyMMdd")).alias("snapshot_id"),
            F.lit(None).cast("bigint").alias("row_count"),
        )
    )
    log = snapshots.current_at_each_commit(commits.unionByName(rollbacks))
    return log.withColumns({"label": F.lit(""), "created_at": F.col("event_at")})


@query
def snapshot_states(spark, root):
    return snapshots.snapshot_states(_snapshot_log(spark, root)).select(
        "snapshot_id", "parent_snapshot_id", "row_count", "is_current", "status"
    )


@query
def snapshot_lineage(spark, root):
    return snapshots.lineage(_snapshot_log(spark, root)).select("snapshot_id", "parent_snapshot_id", "depth")


def _committed(spark: SparkSession, root: str) -> str:
    """The earlier half, the later one without users, and a rollback to the first, as a log."""
    folder = _scratch(spark)
    early, late = _halves(spark, root)
    for i, (name, rows) in enumerate((("early", early), ("late", late.drop("user_id")))):
        rows.write.mode("overwrite").parquet(f"{folder}/work")
        at = datetime(2024, 2, 1 + i, tzinfo=timezone.utc)
        snapshots.commit_snapshot(spark, f"{folder}/work", f"{folder}/log", snapshot_id=name, at=at)
    snapshots.rollback_snapshot(spark, f"{folder}/log", "early", datetime(2024, 2, 3, tzinfo=timezone.utc))
    return f"{folder}/log"


@query
def snapshot_rolled_back(spark, root):
    """The rows of the snapshot that a rollback made current, after their source was overwritten."""
    return snapshots.read_snapshot(spark, _committed(spark, root))


@query
def snapshot_diff_header(spark, root):
    header, _ = snapshots.snapshot_diff(snapshots.read_log(spark, _committed(spark, root)), "early", "late")
    return header.select("snap_a", "snap_b", "schema_changed", "row_count_a", "row_count_b", "row_count_delta")


def _registry_and_changes(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """A feature per user, event type and hour of the day; later events are changes to it."""
    early, late = _halves(spark, root)
    name = F.concat_ws("_", "event_type", F.col("user_id").cast("string"), F.hour("ts").cast("string"))
    definitions = early.groupBy(name.alias("feature_name"), "event_type").agg(
        F.count("*").alias("n"), F.min("ts").alias("created_at"), F.max("ts").alias("updated_at")
    )
    definitions = definitions.select(
        "feature_name",
        F.lit("seen early").alias("description"),
        F.concat(F.lit("team_"), F.col("event_type")).alias("owner"),
        (F.col("n") * 60).cast("int").alias("expected_freshness_seconds"),
        F.lit("float").alias("value_type"),
        F.lit(True).alias("is_active"),
        "created_at",
        "updated_at",
    )
    op = (
        F.when(F.col("value") > 100, "delete")
        .when(F.col("event_type") == "click", "update")
        .when(F.col("event_type") == "view", "create")
        .otherwise("upsert")
    )
    changes = late.select(
        op.alias("op"),
        name.alias("feature_name"),
        F.when(F.col("event_type") == "signup", "changed").alias("description"),
        F.lit("platform").alias("owner"),
        (F.floor("value") - 2).cast("int").alias("expected_freshness_seconds"),
        F.lit(None).cast("string").alias("value_type"),
        F.lit(None).cast("boolean").alias("is_active"),
        F.col("ts").alias("changed_at"),
        "event_id",
    )
    return definitions, changes


@query
def registry_merge(spark, root):
    definitions, changes = _registry_and_changes(spark, root)
    return registry.merge_definitions(definitions, changes, ["changed_at", "event_id"], "changed_at")


@query
def registry_active(spark, root):
    definitions, changes = _registry_and_changes(spark, root)
    merged = registry.merge_definitions(definitions, changes, ["changed_at", "event_id"], "changed_at")
    return registry.list_definitions(merged).select("feature_name", "expected_freshness_seconds")


@query
def registry_refused(spark, root):
    """Changes that were refused where they stood in the order."""
    definitions, changes = _registry_and_changes(spark, root)
    refused = registry.refused_changes(definitions, changes, ["changed_at", "event_id"])
    return refused.select("event_id", "feature_name", "reason")


@query
def registry_change_errors(spark, root):
    _, changes = _registry_and_changes(spark, root)
    return changes.select("event_id", registry.change_error(changes).alias("change_error"))


@query
def registry_conflicts(spark, root):
    definitions, changes = _registry_and_changes(spark, root)
    creates = changes.filter(F.col("op") == "create")
    return registry.conflicts(definitions, creates).select("event_id", "feature_name")


@query
def registry_unknown_updates(spark, root):
    definitions, changes = _registry_and_changes(spark, root)
    updates = changes.filter(F.col("op") == "update")
    return registry.unknown_updates(definitions, updates).select("event_id", "feature_name")


@query
def audit_compaction(spark, root):
    log = _feature_events(spark, root)
    return retention.compacted(log, "event_ts", ["offset"], AS_OF, lag_seconds=2 * 86_400, keep_seconds=20 * 86_400).select(
        "offset", "entity_id", "feature_name", "event_ts"
    )


@query
def audit_compaction_written(spark, root):
    """The same, as the job that writes the compacted log."""
    target = f"{_scratch(spark)}/audit"
    log = _feature_events(spark, root)
    retention.compact_log(log, target, "event_ts", ["offset"], AS_OF, lag_seconds=2 * 86_400, keep_seconds=20 * 86_400)
    return spark.read.parquet(target).select("offset", "entity_id", "feature_name", "event_ts")


@query
def retention_lake(spark, root):
    """Raw events written to lake folders, expired into a new folder and read back."""
    folder = _scratch(spark)
    sinks.write_raw_events(_events(spark, root), f"{folder}/raw", "ts")
    keep = retention.RETENTION_SECONDS["raw_events"]
    retention.expire_lake(
        spark.read.parquet(f"{folder}/raw"), f"{folder}/kept", sinks.RAW_EVENTS_LAYOUT, "ts", AS_OF, keep
    )
    return spark.read.parquet(f"{folder}/kept").drop(*sinks.RAW_EVENTS_LAYOUT)


@query
def retention_manifest(spark, root):
    """Raw events in lake folders, read through the table of live folders after expiry and removal."""
    folder = _scratch(spark)
    raw, live = f"{folder}/raw", f"{folder}/live"
    keep = retention.RETENTION_SECONDS["raw_events"]
    sinks.write_raw_events(_events(spark, root), raw, "ts")
    manifest.register(spark, raw, live)
    manifest.expire(spark, live, AS_OF, keep)
    manifest.remove_dead(spark, raw, live, keep=1)
    return manifest.read_retained(spark, raw, live, "ts", AS_OF, keep).drop(*sinks.RAW_EVENTS_LAYOUT)


@query
def retention_filter(spark, root):
    events = _events(spark, root)
    return retention.retained(events, "ts", AS_OF, retention.RETENTION_SECONDS["raw_events"])


# --- streams ----------------------------------------------------------------------------


def _finish(started) -> None:
    """Wait for a query that stops by itself once all input is read, however long that takes."""
    started.awaitTermination()


@query
def stream_tumbling_1hr(spark, root):
    folder = _scratch(spark)
    events = window_events(inputs.stream_table(spark, root, "events"))
    _finish(stream_windows.start_tumbling(events, 3600, f"{folder}/windows", f"{folder}/checkpoint"))
    return stream_windows.read_tumbling(spark, f"{folder}/windows")


@query
def stream_window_multi(spark, root):
    folder = _scratch(spark)
    events = window_events(inputs.stream_table(spark, root, "events"))
    _finish(stream_windows.start_multi_resolution(events, f"{folder}/panes", f"{folder}/checkpoint"))
    return stream_windows.read_multi_resolution(spark, f"{folder}/panes", like="timestamp_ntz")


@query
def stream_window_multi_sealed(spark, root):
    """The same with a watermark: sealed panes from their table, open ones from the state."""
    folder = _scratch(spark)
    events = window_events(inputs.stream_table(spark, root, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    _finish(stream_windows.start_multi_resolution(events, f"{folder}/sealed", f"{folder}/checkpoint", delay="6 minutes"))
    return stream_windows.read_multi_resolution(spark, f"{folder}/sealed", like="timestamp_ntz", checkpoint=f"{folder}/checkpoint")


@query
def stream_state_latest(spark, root):
    """The latest value of each key, kept in the state of the stream and read from there."""
    checkpoint, order = f"{_scratch(spark)}/checkpoint", ["event_ts", "offset"]
    events = _as_feature_events(inputs.stream_table(spark, root, "events"))
    _finish(state.start_latest_state(events, order, checkpoint))
    return state.read_latest_state(spark, checkpoint, _feature_events(spark, root), order)


@query
def stream_sliding_5min_1min(spark, root):
    folder = _scratch(spark)
    events = window_events(inputs.stream_table(spark, root, "events"))
    _finish(stream_windows.start_sliding(events, f"{folder}/classes", f"{folder}/checkpoint"))
    return stream_windows.read_sliding(spark, f"{folder}/classes", like="timestamp_ntz")


def _ingested(spark: SparkSession, root: str) -> str:
    folder = _scratch(spark)
    messages = _message_stream(inputs.stream_table(spark, root, "events"))
    _finish(
        ingest.start_ingest(
            messages, _definitions(spark), f"{folder}/latest", f"{folder}/dead", f"{folder}/checkpoint",
            ["event_ts", "offset"], buckets=16,
        )
    )
    return folder


@query
def stream_progress(spark, root):
    """What the ingest reported, read back from the table of its progress."""
    path = f"{_scratch(spark)}/progress"
    log = progress.ProgressLog(spark, path, ["messages"])
    spark.streams.addListener(log)
    try:
        _ingested(spark, root)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    counts = progress.current_counts(spark, path)
    metric = {m: F.sum(F.when(F.col("metric") == m, F.col("value"))) for m in ("processed", "failed")}
    return counts.agg(metric["processed"].alias("messages_processed"), metric["failed"].alias("messages_failed"))


@query
def stream_latest_value(spark, root):
    latest = latest_table.read_table(spark, f"{_ingested(spark, root)}/latest")
    return latest.select(
        "entity_id", "feature_name", "value_type", "offset", "ttl_seconds",
        F.col("event_ts").cast("timestamp_ntz").alias("event_ts"),
        F.col("expires_at").cast("timestamp_ntz").alias("expires_at"),
    )


@query
def stream_dead_letters(spark, root):
    return spark.read.parquet(f"{_ingested(spark, root)}/dead").select("offset", "error", "raw_preview", "raw_value")


@query
def stream_deduplicated(spark, root):
    """Every event sent twice, read once."""
    folder = _scratch(spark)
    events = inputs.stream_table(spark, root, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    twice = events.unionByName(events)
    once = inputs.deduplicated(twice, ["event_id"], "ts", "60 days")
    writer = once.writeStream.format("parquet").option("path", f"{folder}/events")
    _finish(writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start())
    return spark.read.parquet(f"{folder}/events").select(
        "event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", "value"
    )


@query
def stream_published_files(spark, root):
    """Keyed messages written to files, read as a stream and stored: all of them arrive, with their metadata."""
    folder = _scratch(spark)
    tags = F.create_map(F.lit("event"), F.col("offset").cast("string"), F.lit("kind"), F.upper("feature_name"))
    sinks.write_messages(msg.to_messages(_feature_events(spark, root).withColumn("metadata", tags)), f"{folder}/topic")
    events = msg.valid_events(msg.parse_messages(inputs.read_message_files(spark, f"{folder}/topic", max_files=4)))
    writer = events.writeStream.format("parquet").option("path", f"{folder}/events")
    _finish(writer.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start())
    back = spark.read.parquet(f"{folder}/events").withColumns(
        {
            "event_id": F.col("metadata.event").cast("bigint"),
            "kind": F.col("metadata.kind"),
            "event_ts": F.col("event_ts").cast("timestamp_ntz"),
        }
    )
    return _number_and_text(back.drop("value", "file"))


@query
def stream_raw_lake(spark, root):
    folder = _scratch(spark)
    events = inputs.stream_table(spark, root, "events")
    _finish(lake.start_raw_events(events, f"{folder}/raw", f"{folder}/checkpoint", "ts", interval=None))
    rows = spark.read.parquet(f"{folder}/raw")
    return rows.groupBy("year", "month", "day", "hour").agg(
        F.count("*").alias("row_count"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event")
    )


@query
def feature_updates_lake(spark, root):
    folder = f"{_scratch(spark)}/updates"
    updates = _feature_events(spark, root).withColumn("entity_type", F.lit("customer"))
    sinks.write_feature_updates(updates, folder, "event_ts")
    return spark.read.parquet(folder).groupBy("entity_type", "year", "month", "day").agg(
        F.count("*").alias("row_count"), F.countDistinct("entity_id").alias("entities")
    )
