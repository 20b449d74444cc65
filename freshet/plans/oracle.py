"""The results of ``freshet.plans.queries`` stated in plain SQL for DuckDB.

Written from the meaning of each query, not from its plan: row windows where
Spark reduces first, ``ASOF`` where it merges, integer cents where it uses
decimals.
"""

from __future__ import annotations

AS_OF = "timestamp '2024-01-31 00:00:00'"
REFERENCE_DATE = "date '2024-01-31'"
SPLIT = "timestamp '2024-01-16 00:00:00'"

CENTS = "cast(round(value * 100) as bigint)"
EXACT = "cast(value as decimal(18, 2))"

ORACLE_SQL: dict[str, str] = {}

# --- spend features -------------------------------------------------------------

WIDE = f"""
txns as (
  select user_id, event_id as txn_id, event_type as category, value, cast(ts as date) as event_date from events
),
rolling as (
  select user_id, txn_id, event_date, value,
         cast(sum({EXACT}) over w as double) / count(*) over w as rolling_7d_spend_avg
  from txns
  window w as (partition by user_id order by event_date range between interval 7 days preceding and current row)
),
stats as (
  select user_id,
         cast(sum({EXACT}) as double) / count(*) as mu,
         sqrt(cast(count(*) * sum(cast({CENTS} as hugeint) * {CENTS}) - sum({CENTS}) * sum({CENTS}) as double) / 10000.0
              / (cast(count(*) as double) * (count(*) - 1))) as sigma,
         cast(date_diff('day', max(event_date), {REFERENCE_DATE}) as integer) as recency_days,
         count(*) as frequency,
         cast(sum({EXACT}) as double) as monetary
  from txns group by user_id
),
counts as (select user_id, category, count(*) as cat_count from txns group by user_id, category),
best as (
  select user_id, category as top_merchant_category, cat_count as merchant_category_count
  from counts qualify row_number() over (partition by user_id order by cat_count desc, category) = 1
),
scores as (
  select r.user_id, r.txn_id, r.event_date, r.rolling_7d_spend_avg,
         case when s.sigma is null or s.sigma = 0 then 0.0 else (r.value - s.mu) / s.sigma end as anomaly_score
  from rolling r join stats s using (user_id)
),
wide as (
  select c.*, b.top_merchant_category, b.merchant_category_count, s.recency_days, s.frequency, s.monetary
  from scores c join best b using (user_id) join stats s using (user_id)
)
"""

ORACLE_SQL["rolling_7d_spend_avg"] = f"with {WIDE} select user_id, txn_id, event_date, rolling_7d_spend_avg from rolling"
ORACLE_SQL["category_counts"] = (
    "select user_id, event_type as merchant_category, count(*) as cat_count from events group by all"
)
ORACLE_SQL["top_merchant_category"] = f"with {WIDE} select * from best"
ORACLE_SQL["anomaly_score"] = f"with {WIDE} select user_id, txn_id, event_date, anomaly_score from scores"
ORACLE_SQL["rfm"] = f"with {WIDE} select user_id, recency_days, frequency, monetary from stats"
ORACLE_SQL["user_features_wide"] = f"with {WIDE} select * from wide"
ORACLE_SQL["feature_table_roundtrip"] = ORACLE_SQL["user_features_wide"]

# --- declared features ----------------------------------------------------------

ORACLE_SQL["rolling_7d_spend"] = f"""
select event_id, user_id, cast(sum({EXACT}) over w as double) as rolling_7d_spend from events
window w as (partition by user_id order by ts range between interval 7 days preceding and current row)"""
ORACLE_SQL["order_count_24h"] = """
select o_orderkey as order_id, o_custkey as entity_id, count(*) over w as order_count_24h from orders
window w as (partition by o_custkey order by o_orderdate range between interval 24 hours preceding and current row)"""
ORACLE_SQL["event_count_24h"] = """
select event_id, user_id, count(*) over w as event_count_24h from events
window w as (partition by user_id order by ts range between interval 24 hours preceding and current row)"""
ORACLE_SQL["avg_basket_size"] = """
select o_orderkey as order_id, o_custkey as entity_id,
       cast(sum(cast(o_totalprice as decimal(18, 2))) over w as double) / count(*) over w as avg_basket_size
from orders
window w as (partition by o_custkey order by o_orderdate, o_orderkey rows between 29 preceding and current row)"""
ORACLE_SQL["avg_event_value_30"] = f"""
select event_id, user_id, cast(sum({EXACT}) over w as double) / count(*) over w as avg_event_value_30 from events
window w as (partition by user_id order by ts, event_id rows between 29 preceding and current row)"""
ORACLE_SQL["avg_basket_size_now"] = """
select o_custkey as entity_id, cast(sum(cast(o_totalprice as decimal(18, 2))) as double) / count(*) as avg_basket_size,
       count(*) as orders_used
from (select * from orders
      qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) <= 30)
group by o_custkey"""
ORACLE_SQL["days_since_last_order"] = """
select o_custkey as entity_id,
       (epoch_us(timestamp '2001-12-31 12:00:00') - epoch_us(max(o_orderdate))) / 86400000000.0::double
         as days_since_last_order
from orders where o_orderdate <= timestamp '2001-12-31 12:00:00' group by o_custkey"""
ORACLE_SQL["preferred_category"] = """
with bought as (
  select o_custkey as customer_id, p_brand, count(*) as n
  from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey group by all)
select customer_id, p_brand as preferred_category, n as lines_bought from bought
qualify row_number() over (partition by customer_id order by n desc, p_brand) = 1"""

SESSIONS = """
marked as (
  select user_id, ts,
         case when ts - lag(ts) over (partition by user_id order by ts) <= interval 30 minutes then 0 else 1 end as opens
  from {source}),
placed as (select *, sum(opens) over (partition by user_id order by ts) as nr from marked),
found as (select user_id, nr, min(ts) as first_ts, max(ts) as last_ts, count(*) as n from placed group by user_id, nr)
"""
ORACLE_SQL["sessions_30min"] = f"""
with {SESSIONS.format(source="events")}
select user_id, first_ts as session_start, last_ts + interval 30 minutes as session_end, n as event_count from found"""
ORACLE_SQL["session_count_1h"] = f"""
with {SESSIONS.format(source="events")},
hours as (
  select user_id, unnest(generate_series(date_trunc('hour', first_ts), date_trunc('hour', last_ts), interval 1 hour)) as h
  from found)
select user_id, h as window_start, h + interval 1 hour as window_end, count(*) as session_count from hours group by all"""
ORACLE_SQL["session_count_last_day"] = f"""
with recent as (select * from events where ts between {AS_OF} - interval 1 day and {AS_OF}),
{SESSIONS.format(source="recent")}
select user_id, count(*) as session_count from found group by user_id"""

# --- lookups --------------------------------------------------------------------

# adding zero turns a rounded minus zero into zero
VECTOR = """
       max(top_merchant_category) as top_merchant_category,
       max(recency_days) as recency_days, max(frequency) as frequency, max(monetary) as monetary,
       round(avg(rolling_7d_spend_avg), 6) + 0.0 as rolling_7d_spend_avg,
       round(avg(anomaly_score), 6) + 0.0 as anomaly_score,
       max(merchant_category_count) as merchant_category_count
"""
ORACLE_SQL["user_feature_vector"] = f"with {WIDE} select user_id, {VECTOR} from wide group by user_id"
ORACLE_SQL["user_feature_vector_latest"] = f"""
with {WIDE}, newest as (
  select * from wide qualify event_date = max(event_date) over (partition by user_id))
select user_id, {VECTOR} from newest group by user_id"""
ORACLE_SQL["single_user_vector"] = f"with {WIDE} select user_id, {VECTOR} from wide where user_id = 7 group by user_id"

_METRICS = {
    "recency_days": "max(recency_days)",
    "frequency": "max(frequency)",
    "monetary": "max(monetary)",
    "rolling_7d_spend_avg": "round(avg(rolling_7d_spend_avg), 6) + 0.0",
    "anomaly_score": "round(avg(anomaly_score), 6) + 0.0",
    "merchant_category_count": "max(merchant_category_count)",
}
for _metric, _aggregate in _METRICS.items():
    for _direction in ("asc", "desc"):
        ORACLE_SQL[f"topk_{_metric}_{_direction}"] = f"""
with {WIDE} select user_id, {_aggregate} as {_metric} from wide group by user_id
order by {_metric} {_direction} nulls last, user_id limit 10"""

_DRIFT = " union all ".join(
    f"select '{n}' as feature, round(coalesce(avg({n}), 0), 6) + 0.0 as mean, "
    f"round(coalesce(stddev_samp({n}), 0), 6) as std, round(coalesce(min({n}), 0)::double, 6) as min, "
    f"round(coalesce(max({n}), 0)::double, 6) as max from wide"
    for n in _METRICS
)
ORACLE_SQL["drift_summary"] = f"with {WIDE} {_DRIFT}"
ORACLE_SQL["feature_row_count"] = (
    f"with {WIDE} select count(*) as row_count, count(distinct event_date) as partitions from wide"
)
ORACLE_SQL["feature_view_sql"] = (
    f"with {WIDE} select event_date, top_merchant_category, count(*) as row_count, count(distinct user_id) as users, "
    "max(frequency) as most_frequent from wide where event_date >= date '2024-01-20' group by all"
)
ORACLE_SQL["partition_rows"] = "select cast(ts as date) as event_date, count(*) as row_count from events group by all"
ORACLE_SQL["recent_events"] = "select * from events order by ts desc, event_id desc limit 20"

# --- windows --------------------------------------------------------------------

# the mean of cents rounded half up, in integers
STATISTICS = f"""
count(*) as "count",
cast(sum({EXACT}) as double) as total_amount,
cast(cast((2 * sum({CENTS}) + count(*)) // (2 * count(*)) as bigint) as double) / 100 as avg_amount,
min(value) as min_amount, max(value) as max_amount, count(distinct user_id) as unique_users
"""
EMPTY_AS_ZERO = """
coalesce("count", 0) as "count", coalesce(total_amount, 0) as total_amount, coalesce(avg_amount, 0) as avg_amount,
coalesce(min_amount, 0) as min_amount, coalesce(max_amount, 0) as max_amount, coalesce(unique_users, 0) as unique_users
"""


def _tumbling(seconds: int) -> str:
    start = f"make_timestamp((epoch_us(ts) // {seconds}000000) * {seconds}000000)"
    return (
        f"select {start} as window_start, {start} + interval {seconds} seconds as window_end, {STATISTICS} "
        "from events group by 1, 2"
    )


def _sliding(window: int, step: int, source: str = "events", empty: bool = True, bounded: bool = True) -> str:
    """Closed windows: a start s holds events with s <= ts <= s + window."""
    bound = "where w between (select lo from bounds) and (select hi from bounds)" if bounded else ""
    starts = "(select unnest(generate_series(lo, hi)) as w from bounds)" if empty else f"(select w from filled {bound})"
    return f"""
with src as ({source if source.startswith("select") else f"select * from {source}"}),
bounds as (
  select cast(ceil(epoch_us(min(ts)) / {step}e6) as bigint) as lo,
         (epoch_us(max(ts)) + {step}000000 - {window}000000) // {step}000000 as hi from src),
held as (
  select unnest(generate_series(cast(ceil((epoch_us(ts) - {window}000000) / {step}e6) as bigint),
                                epoch_us(ts) // {step}000000)) as w, value, user_id from src),
filled as (select w, {STATISTICS} from held group by w)
select make_timestamp(w * {step}000000) as window_start,
       make_timestamp(w * {step}000000 + {window}000000) as window_end, {EMPTY_AS_ZERO}
from {starts} left join filled using (w)"""


ORACLE_SQL["tumbling_1min"] = _tumbling(60)
ORACLE_SQL["tumbling_5min"] = _tumbling(300)
ORACLE_SQL["tumbling_1hr"] = _tumbling(3600)
ORACLE_SQL["sliding_5min_1min"] = _sliding(300, 60)
ORACLE_SQL["sliding_1hr_7min"] = _sliding(3600, 420)
ORACLE_SQL["sliding_tail"] = _sliding(
    3600, 600, "select * from events where ts >= (select max(ts) - interval 1 day from events)"
)
ORACLE_SQL["sliding_point"] = f"""
select timestamp '2024-01-15 11:00:00' as window_start, timestamp '2024-01-15 12:00:00' as window_end, {STATISTICS}
from events where ts between timestamp '2024-01-15 11:00:00' and timestamp '2024-01-15 12:00:00'"""
ORACLE_SQL["sliding_probes"] = f"""
select p.event_id, any_value(p.at) as at, any_value(p.at) - interval 1 hour as window_start, any_value(p.at) as window_end, {STATISTICS}
from (select event_id, ts as at from events) p
join (select ts, value, user_id from events) e on e.ts between p.at - interval 1 hour and p.at
group by p.event_id"""
ORACLE_SQL["tumbling_ordered"] = _tumbling(300)
ORACLE_SQL["sliding_latest"] = f"""
with e as (select max(ts) as t from events)
select any_value(t) - interval 1 hour as window_start, any_value(t) as window_end, {STATISTICS}
from events, e where ts between t - interval 1 hour and t"""
_MULTI = " union all by name ".join(
    f"select '{name}' as window_type, * from ({_tumbling(size)})"
    for name, size in (("1min", 60), ("5min", 300), ("1hr", 3600))
)
ORACLE_SQL["window_multi"] = (
    f"{_MULTI} union all by name select 'sliding' as window_type, * from ({_sliding(300, 60)})"
)
ORACLE_SQL["stream_tumbling_1hr"] = _tumbling(3600)
ORACLE_SQL["stream_window_multi"] = ORACLE_SQL["window_multi"]
ORACLE_SQL["stream_window_multi_sealed"] = ORACLE_SQL["window_multi"]
ORACLE_SQL["stream_sliding_5min_1min"] = _sliding(300, 60)

# --- messages and freshness -------------------------------------------------------

DEFINITIONS = """
definitions(feature_name, sla, is_active) as (values
  ('click', 86400, true), ('view', 172800, true), ('purchase', 259200, true), ('signup', 345600, true),
  ('error', 432000, false)),
slas as (select feature_name, sla from definitions where is_active)
"""
ENTITY = "'customer_' || repeat('0', greatest(0, 5 - length(cast(user_id as varchar)))) || cast(user_id as varchar)"
ISO = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')"

# what each message says, by the property that breaks it
MESSAGES = f"""
told as (
  select event_id, ts, event_type, value, cast(json_extract_string(props, '$.k') as integer) as k,
         case when cast(json_extract_string(props, '$.k') as integer) = 2 then '   ' else {ENTITY} end as entity,
         {ISO} as stamp,
         case event_type when 'view' then cast(cast(floor(value) as bigint) as varchar)
                         when 'signup' then '"v' || cast(value as varchar) || '"'
                         when 'error' then case when value > 50 then 'true' else 'false' end
                         else cast(value as varchar) end as json_value,
         case event_type when 'view' then 'int' when 'signup' then 'str' when 'error' then 'bool' else 'float' end as tag
  from events),
sent as (
  select *, '{{"entity_id":"' || entity || '","feature_name":"'
         || case k when 0 then 'bad-name' when 1 then upper(event_type) else event_type end
         || '","value":' || case when k = 4 then 'null' else json_value end
         || ',"timestamp":"' || case when k = 3 then 'yesterday' else stamp end || '","source":"web"}}' as whole
  from told),
judged as (
  select *, case k when 5 then left(whole, 40) when 6 then '[]' else whole end as message,
         case k when 0 then 'feature_name_characters' when 1 then 'feature_name_case' when 2 then 'entity_id_blank'
                when 3 then 'timestamp_invalid' when 4 then 'value_type' when 5 then 'malformed_json'
                when 6 then 'not_an_object' end as error
  from sent)
"""
ORACLE_SQL["event_validation"] = f"""
with {MESSAGES}
select event_id as "offset", entity as entity_id, event_type as feature_name, tag as value_type, ts as event_ts,
       'web' as source, '1.0' as schema_version,
       case when tag in ('int', 'float') then cast(json_value as double) end as value_number,
       case when tag in ('str', 'bool') then replace(json_value, '"', '') end as value_text
from judged where error is null"""
_DEAD = "select event_id as \"offset\", error, left(message, 200) as raw_preview, message as raw_value from judged where error is not null"
ORACLE_SQL["dlq_split"] = f"with {MESSAGES} {_DEAD}"
ORACLE_SQL["stream_dead_letters"] = ORACLE_SQL["dlq_split"]
ORACLE_SQL["processing_counts"] = f"""
with {MESSAGES} select count(*) filter (error is null) as messages_processed,
count(*) filter (error is not null) as messages_failed from judged"""
ORACLE_SQL["stream_latest_value"] = f"""
with {MESSAGES}, {DEFINITIONS},
last as (select * from judged where error is null
         qualify row_number() over (partition by entity, event_type order by ts desc, event_id desc) = 1)
select entity as entity_id, event_type as feature_name, tag as value_type, event_id as "offset",
       cast(2 * coalesce(sla, 120) as bigint) as ttl_seconds, ts as event_ts,
       ts + to_seconds(2 * coalesce(sla, 120)) as expires_at
from last left join slas on event_type = feature_name"""
ORACLE_SQL["stream_progress"] = ORACLE_SQL["processing_counts"]
ORACLE_SQL["published_messages"] = f"""
select {ENTITY} as key, {ENTITY} as entity_id, event_type as feature_name, 'float' as value_type, ts as event_ts,
       'web' as source, '1.0' as schema_version, value as value_number, cast(null as varchar) as value_text from events"""
ORACLE_SQL["key_validation"] = """
select event_id, case event_type when 'error' then 'entity_id' when 'signup' then 'feature_name' end as key_error
from events"""

LATEST = f"""
{DEFINITIONS},
stored as (
  select {ENTITY} as entity_id, event_type as feature_name, value, ts, event_id from events
  qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1),
latest as (
  select s.*, ts + to_seconds(2 * coalesce(sla, 120)) as expires_at from stored s left join slas using (feature_name)),
checked as (
  select l.*, sla, (epoch_us({AS_OF}) - epoch_us(ts)) / 1e6::double as age_seconds,
         (epoch_us({AS_OF}) - epoch_us(ts)) / 1e6::double > sla as is_stale
  from latest l join slas using (feature_name)),
sweep as (
  select feature_name, any_value(sla) as sla_seconds, count(*) filter (is_stale) as stale_count, count(*) as total_count
  from checked group by feature_name)
"""
_LATEST_COLUMNS = f"""
select {ENTITY} as entity_id, event_type as feature_name, cast(value as varchar) as value_raw, 'float' as value_type,
       ts as event_ts, 'web' as source, '1.0' as schema_version, ts as written_at, event_id as "offset" """
ORACLE_SQL["latest_value"] = f"""{_LATEST_COLUMNS} from events
qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1"""
ORACLE_SQL["stream_state_latest"] = ORACLE_SQL["latest_value"]
ORACLE_SQL["latest_value_arrival"] = f"""{_LATEST_COLUMNS}, value as arrival from events
qualify row_number() over (partition by user_id, event_type order by value desc, event_id desc) = 1"""
ORACLE_SQL["value_expiry"] = f"""
with {DEFINITIONS}
select event_id as "offset", event_type as feature_name, cast(2 * coalesce(sla, 120) as bigint) as ttl_seconds,
       ts + to_seconds(2 * coalesce(sla, 120)) as expires_at
from events left join slas on event_type = feature_name"""
ORACLE_SQL["ttl_visible"] = f"""
with {LATEST} select entity_id, feature_name, ts as event_ts, expires_at from latest where expires_at > {AS_OF}"""

ANSWER = """
cast(value as varchar) as value, case when value is not null then 'float' end as value_type, ts as "timestamp",
round(age, 2) as age_seconds, case when ts is null then true else coalesce(age > sla, false) end as is_stale,
sla as freshness_sla_seconds
"""
_WANTED = f"""
wanted as (
  select e.entity_id, s.feature_name, s.sla from (select distinct entity_id from stored) e, slas s),
answers as (
  select w.entity_id, w.feature_name, value, ts, w.sla, (epoch_us({AS_OF}) - epoch_us(ts)) / 1e6::double as age
  from wanted w left join latest l using (entity_id, feature_name)),
told as (select entity_id, feature_name, {ANSWER} from answers)
"""
ORACLE_SQL["entity_freshness"] = f"with {LATEST}, {_WANTED} select * from told"
ORACLE_SQL["entity_summary"] = f"""
with {LATEST}, {_WANTED}
select entity_id, count(*) as total_features, count(*) filter (is_stale) as stale_features from told group by entity_id"""
_FIELDS = ["value", "value_type", '"timestamp"', "age_seconds", "is_stale", "freshness_sla_seconds"]
_ENTRIES = ", ".join(
    f"any_value({f}) filter (feature_name = '{n}') as {n}_{f.strip(chr(34))}"
    for n in ("click", "view", "purchase", "signup")
    for f in _FIELDS
)
ORACLE_SQL["entity_feature_maps"] = f"""
with {LATEST}, {_WANTED}
select entity_id, cast(count(*) as integer) as features, {_ENTRIES} from told group by entity_id"""
ORACLE_SQL["single_feature"] = f"""
with {LATEST},
requests as (
  select {ENTITY.replace("user_id", "c_custkey")} as entity_id,
         case lower(c_mktsegment) when 'building' then 'error' when 'machinery' then 'unknown' else 'click' end
           as feature_name
  from customer),
answers as (
  select r.entity_id, r.feature_name, value, ts, s.sla, (epoch_us({AS_OF}) - epoch_us(ts)) / 1e6::double as age
  from requests r left join latest l using (entity_id, feature_name) left join slas s using (feature_name))
select entity_id, feature_name, {ANSWER} from answers"""
ORACLE_SQL["sla_sweep"] = f"with {LATEST} select * from sweep"
ORACLE_SQL["sla_sweep_visible"] = f"""
with {LATEST}
select feature_name, any_value(sla) as sla_seconds, count(*) filter (is_stale) as stale_count, count(*) as total_count
from checked where expires_at > {AS_OF} group by feature_name"""
ORACLE_SQL["stale_entities"] = f"with {LATEST} select feature_name, entity_id, age_seconds from checked where is_stale"
ORACLE_SQL["health"] = f"""
with {LATEST}
select case when sum(stale_count) > 0 then 'degraded' else 'healthy' end as status,
       cast(sum(stale_count) as bigint) as stale_feature_count,
       cast(sum(total_count) as bigint) as total_monitored_features from sweep"""
ORACLE_SQL["stale_bands"] = f"""
with {LATEST},
shares as (
  -- tenths of a percent, rounded half up in integers
  select *, ((2000 * stale_count + total_count) // (2 * total_count)) / 10.0::double as stale_percent from sweep)
select feature_name, stale_count, total_count, stale_percent,
       case when stale_percent > 5 then 'error' when stale_percent > 1 then 'warn' else 'ok' end as percent_band,
       case when stale_count > 100 then 'error' when stale_count > 10 then 'warn' else 'ok' end as count_band
from shares"""
ORACLE_SQL["feature_group_rollup"] = f"""
with {LATEST},
grouped as (
  select case when feature_name in ('click', 'view') then 'browse' else 'convert' end as feature_group,
         count(*) as feature_count,
         cast(sum(epoch_us({AS_OF}) - epoch_us(ts)) as double) / count(*) / 1000.0::double as avg_freshness_ms,
         count(*) filter (is_stale) as stale_features_count, max(ts) as last_materialization_time
  from checked group by 1)
select *, round(stale_features_count / feature_count, 6) as stale_ratio,
       case when avg_freshness_ms < 1000 then cast(cast(round(avg_freshness_ms) as bigint) as varchar) || 'ms'
            when avg_freshness_ms < 60000 then printf('%.1fs', avg_freshness_ms / 1000)
            when avg_freshness_ms < 3600000 then cast(cast(round(avg_freshness_ms / 60000) as bigint) as varchar) || 'm'
            else printf('%.1fh', avg_freshness_ms / 3600000) end as freshness_label,
       case when avg_freshness_ms < 5000 then 'good' when avg_freshness_ms < 60000 then 'warn' else 'stale' end
         as freshness_band
from grouped"""
_MOMENTS = ["2024-01-08", "2024-01-15", "2024-01-22", "2024-01-31"]
_SWEEPS = " union all ".join(
    f"""
  select timestamp '{m} 00:00:00' as swept_at, feature_name,
         count(*) filter ((epoch_us(timestamp '{m} 00:00:00') - epoch_us(ts)) / 1e6 > sla) as stale_count
  from (select event_type as feature_name, ts from events where ts <= timestamp '{m} 00:00:00'
        qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1)
  join slas using (feature_name)
  where ts + to_seconds(2 * sla) > timestamp '{m} 00:00:00' group by feature_name"""
    for m in _MOMENTS
)
ORACLE_SQL["sla_violations_total"] = f"""
with {DEFINITIONS}, sweeps as ({_SWEEPS})
select feature_name, cast(sum(stale_count) as bigint) as total_violations, count(*) as sweeps, max(swept_at) as last_run
from sweeps group by feature_name"""
ORACLE_SQL["sla_violations_swept"] = ORACLE_SQL["sla_violations_total"]

_DUE_SWEEPS = " union all ".join(
    f"""
select timestamp '{m}' as swept_at, feature_name, any_value(sla) as sla_seconds,
       count(*) filter ((epoch_us(timestamp '{m}') - epoch_us(ts)) / 1e6 > sla) as stale_count, count(*) as total_count
from (select event_type as feature_name, ts from events where ts <= timestamp '{m}'
      qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1)
join slas using (feature_name) group by feature_name"""
    for m in [*(f"{m} 00:00:00" for m in _MOMENTS), "2024-02-01 12:00:00", "2024-02-03 00:00:00"]
)
ORACLE_SQL["sweep_incremental"] = f"with {DEFINITIONS} {_DUE_SWEEPS}"

# --- training rows ------------------------------------------------------------------

ORACLE_SQL["point_in_time_latest"] = """
select l.event_id, l.user_id, l.ts, f.value as feature_value, f.ts as feature_ts
from (select * from events where event_type = 'purchase') l
asof left join (select * from events where event_type <> 'purchase') f on l.user_id = f.user_id and l.ts >= f.ts"""
_NAMES = ["click", "view", "purchase", "signup", "error"]
_SEEN = ", ".join(f"f_{n}.value as {n}, f_{n}.ts as {n}_ts" for n in _NAMES)
_MEETS = "\n".join(
    f"asof left join (select * from events where event_type = '{n}') f_{n} on l.user_id = f_{n}.user_id and l.ts >= f_{n}.ts"
    for n in _NAMES
)
ORACLE_SQL["point_in_time_features"] = f"""
select l.event_id, l.user_id, l.ts, {_SEEN}
from (select * from events where event_type = 'purchase') l
{_MEETS}"""

# --- snapshots, registry, retention ----------------------------------------------------


def _profile(source: str, columns: dict[str, str], digits: int | None = 6) -> str:
    """Per column; ``columns`` maps a name to its value in cents."""

    def spread(c: str) -> str:
        total, squares = f"sum(cast({c} as hugeint))", f"sum(cast({c} as hugeint) * {c})"
        return (
            f"sqrt(cast(count(*) * {squares} - {total} * {total} as double) / 10000.0"
            " / (cast(count(*) as double) * (count(*) - 1)))"
        )

    def shown(c: str) -> str:
        return f"round({spread(c)}, {digits})" if digits is not None else spread(c)

    return " union all ".join(
        f"select '{n}' as column_name, count(*) as row_count, cast(sum({c}) as double) / 100.0 / count(*) as mean, "
        f"{shown(c)} as std, cast(min({n}) as double) as min, cast(max({n}) as double) as max from {source}"
        for n, c in columns.items()
    )


_IDS = {"event_id": "(event_id * 100)", "user_id": "(user_id * 100)", "value": CENTS}
ORACLE_SQL["snapshot_profile"] = (
    f"select * from ({_profile('events', _IDS)})"
)
ORACLE_SQL["snapshot_profile_merged"] = ORACLE_SQL["snapshot_profile"]
_DELTAS = ", ".join(
    f"round(coalesce(a.{s}, 0), 4) as {s}_a, round(coalesce(b.{s}, 0), 4) as {s}_b, "
    f"round(coalesce(b.{s}, 0) - coalesce(a.{s}, 0), 4) as {s}_delta"
    for s in ("mean", "std", "min", "max")
)
ORACLE_SQL["snapshot_diff"] = f"""
with early as (select * from events where ts < {SPLIT}), late as (select * from events where ts >= {SPLIT}),
a as ({_profile("early", _IDS, None)}),
b as ({_profile("late", {n: c for n, c in _IDS.items() if n != "user_id"}, None)})
select coalesce(a.column_name, b.column_name) as feature, {_DELTAS} from a full join b using (column_name)"""
ORACLE_SQL["snapshot_drift"] = f"""
with daily as (
  select strftime(ts, '%Y%m%d') as snapshot_id, count(*) as row_count,
         cast(sum({EXACT}) as double) / count(*) as mean,
         case when count(*) > 1 then
           sqrt(cast(count(*) * sum(cast({CENTS} as hugeint) * {CENTS}) - sum({CENTS}) * sum({CENTS}) as double) / 10000.0
                / (cast(count(*) as double) * (count(*) - 1))) end as std
  from events group by 1)
select snapshot_id, row_count, mean, round(std, 6) as std,
       round(mean - lag(mean) over (order by snapshot_id), 4) as mean_delta
from daily"""

LOG = f"""
daily as (
  select cast(ts as date) as d, count(*) as row_count, sum({CENTS}) as turnover from events group by 1),
log as (
  select 'commit' as event_type, cast(d as varchar) || 'T12' as event_at, 'snap_' || strftime(d, '%Y%m%d') as snapshot_id,
         row_count from daily
  union all
  select 'rollback', cast(a.d as varchar) || 'T18', 'snap_' || strftime(b.d, '%Y%m%d'), null
  from daily a join daily b on b.d = a.d - 1 where a.turnover < b.turnover),
linked as (select *, lag(snapshot_id) over (order by event_at) as before from log),
states as (
  select snapshot_id, before as parent_snapshot_id, row_count,
         snapshot_id = (select max_by(snapshot_id, event_at) from log) as is_current
  from linked where event_type = 'commit')
"""
ORACLE_SQL["snapshot_drift_merged"] = ORACLE_SQL["snapshot_drift"]
ORACLE_SQL["snapshot_states"] = f"""
with {LOG} select *, case when is_current then 'current' else 'archived' end as status from states"""
ORACLE_SQL["snapshot_lineage"] = f"""
with recursive {LOG},
chain as (
  select snapshot_id, parent_snapshot_id, 0 as depth from states where is_current
  union all
  select s.snapshot_id, s.parent_snapshot_id, c.depth + 1 from chain c join states s on s.snapshot_id = c.parent_snapshot_id)
select * from chain"""

ORACLE_SQL["snapshot_rolled_back"] = f"select * from events where ts < {SPLIT}"
ORACLE_SQL["snapshot_diff_header"] = f"""
with counts as (
  select count(*) filter (ts < {SPLIT}) as row_count_a, count(*) filter (ts >= {SPLIT}) as row_count_b from events)
select 'early' as snap_a, 'late' as snap_b, true as schema_changed, *, row_count_b - row_count_a as row_count_delta
from counts"""

CHANGES = f"""
defs as (
  select event_type || '_' || user_id || '_' || hour(ts) as feature_name, 'seen early' as description, 'team_' || event_type as owner,
         cast(count(*) * 60 as integer) as sla, min(ts) as created_at, max(ts) as updated_at
  from events where ts < {SPLIT} group by event_type, user_id, hour(ts)),
changes as (
  select event_id, ts, event_type || '_' || user_id || '_' || hour(ts) as feature_name,
         case when value > 100 then 'delete' when event_type = 'click' then 'update'
              when event_type = 'view' then 'create' else 'upsert' end as op,
         case when event_type = 'signup' then 'changed' end as description,
         cast(floor(value) as integer) - 2 as sla
  from events where ts >= {SPLIT}),
steps as (
  select *, row_number() over (partition by feature_name order by ts, event_id) as k from changes where sla > 0),
names as (select feature_name from defs union select feature_name from steps),
replay as (
  select n.feature_name, 0 as k, d.feature_name is not null as known, d.description, d.owner, d.sla,
         d.feature_name is not null as is_active, d.created_at, d.updated_at,
         cast(null as bigint) as event_id, cast(null as varchar) as reason
  from names n left join defs d using (feature_name)
  union all
  select r.feature_name, s.k, known or adds,
         case when adds then coalesce(s.description, '') when edits then coalesce(s.description, r.description)
              else r.description end,
         case when adds or edits then 'platform' else r.owner end,
         case when adds or edits then s.sla else r.sla end,
         case when adds or (edits and s.op = 'upsert') then true when known and s.op = 'delete' then false
              else r.is_active end,
         case when adds then s.ts else r.created_at end,
         case when adds or edits or (known and s.op = 'delete') then s.ts else r.updated_at end,
         s.event_id,
         case when known and s.op = 'create' then 'taken' when not known and s.op in ('update', 'delete') then 'unknown' end
  from replay r join steps s on s.feature_name = r.feature_name and s.k = r.k + 1,
       lateral (select not r.known and s.op in ('create', 'upsert') as adds,
                       r.known and s.op in ('update', 'upsert') as edits) judged),
merged as (
  select feature_name, description, owner, sla as expected_freshness_seconds, 'float' as value_type, is_active,
         created_at, updated_at
  from replay where known
  qualify row_number() over (partition by feature_name order by k desc) = 1)
"""
ORACLE_SQL["registry_merge"] = f"with recursive {CHANGES} select * from merged"
ORACLE_SQL["registry_active"] = (
    f"with recursive {CHANGES} select feature_name, expected_freshness_seconds from merged where is_active"
)
ORACLE_SQL["registry_refused"] = f"""
with recursive {CHANGES} select event_id, feature_name, reason from replay where reason is not null"""
ORACLE_SQL["registry_change_errors"] = f"""
with recursive {CHANGES} select event_id, case when sla <= 0 then 'expected_freshness_seconds' end as change_error from changes"""
ORACLE_SQL["registry_conflicts"] = f"""
with recursive {CHANGES} select event_id, feature_name from changes
where op = 'create' and feature_name in (select feature_name from defs)"""
ORACLE_SQL["registry_unknown_updates"] = f"""
with recursive {CHANGES} select event_id, feature_name from changes
where op = 'update' and feature_name not in (select feature_name from defs)"""
ORACLE_SQL["audit_compaction"] = f"""
with kept as (select *, {ENTITY} as entity_id from events where ts >= {AS_OF} - interval 20 days)
select event_id as "offset", entity_id, event_type as feature_name, ts as event_ts from kept
where ts >= {AS_OF} - interval 2 days
union all
select event_id, entity_id, event_type, ts from (
  select * from kept where ts < {AS_OF} - interval 2 days
  qualify row_number() over (partition by user_id, event_type order by event_id desc) = 1)"""
ORACLE_SQL["retention_filter"] = f"select * from events where ts >= {AS_OF} - interval 7 days"

ORACLE_SQL["retention_lake"] = ORACLE_SQL["retention_filter"]
ORACLE_SQL["retention_manifest"] = ORACLE_SQL["retention_filter"]
ORACLE_SQL["audit_compaction_written"] = ORACLE_SQL["audit_compaction"]

# --- streams and lake ---------------------------------------------------------------------

ORACLE_SQL["stream_deduplicated"] = "select event_id, ts, user_id, value from events"
ORACLE_SQL["stream_published_files"] = f"""
select {ENTITY} as key, {ENTITY} as entity_id, event_type as feature_name, 'float' as value_type, ts as event_ts,
       'web' as source, '1.0' as schema_version, value as value_number, cast(null as varchar) as value_text,
       event_id, upper(event_type) as kind from events"""
ORACLE_SQL["stream_raw_lake"] = """
select cast(year(ts) as integer) as "year", cast(month(ts) as integer) as "month", cast(day(ts) as integer) as "day",
       cast(hour(ts) as integer) as "hour", count(*) as row_count, min(event_id) as first_event,
       max(event_id) as last_event
from events group by all"""
ORACLE_SQL["feature_updates_lake"] = """
select 'customer' as entity_type, cast(year(ts) as integer) as "year", cast(month(ts) as integer) as "month",
       cast(day(ts) as integer) as "day", count(*) as row_count, count(distinct user_id) as entities
from events group by all"""
