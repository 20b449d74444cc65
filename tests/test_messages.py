from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from freshet.functions import messages as msg
from freshet.sources.sinks import write_messages

GOOD = '{"entity_id":"order_001","feature_name":"rolling_7d_spend","value":142.5,"timestamp":"2024-01-01T00:00:00Z"}'


def parse(spark, *texts, **columns):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "offset int, value string")
    for name, value in columns.items():
        df = df.withColumn(name, F.lit(value))
    return msg.parse_messages(df, received_at="received_at" if "received_at" in columns else None)


def event(**fields):
    import json

    base = {"entity_id": "e", "feature_name": "f", "value": 1, "timestamp": "2024-01-01"}
    base.update(fields)
    return json.dumps({k: v for k, v in base.items() if v is not ...})


def test_valid_message(spark):
    (row,) = parse(spark, GOOD).collect()
    assert row.error is None
    assert (row.entity_id, row.feature_name, row.value_raw, row.value_type) == ("order_001", "rolling_7d_spend", "142.5", "float")
    assert (row.schema_version, row.source, row.metadata) == ("1.0", None, None)


@pytest.mark.parametrize(
    ("value", "tag", "raw"), [(5, "int", "5"), ("5", "str", "5"), (5.5, "float", "5.5"), (True, "bool", "true"), ("", "str", "")]
)
def test_value_keeps_its_type(spark, value, tag, raw):
    (row,) = parse(spark, event(value=value)).collect()
    assert (row.error, row.value_type, row.value_raw) == (None, tag, raw)


@pytest.mark.parametrize(
    ("text", "error"),
    [
        (None, "empty_message"),
        ("not-valid-json", "malformed_json"),
        (GOOD + " trailing", "malformed_json"),
        ("", "malformed_json"),
        ("[1]", "not_an_object"),
        ("null", "not_an_object"),
        (event(entity_id=...), "entity_id_missing"),
        (event(entity_id=7), "entity_id_type"),
        (event(entity_id=" \t\n"), "entity_id_blank"),
        (event(entity_id=" "), "entity_id_blank"),
        (event(feature_name=...), "feature_name_missing"),
        (event(feature_name="feature-name!"), "feature_name_characters"),
        (event(feature_name="f\n"), "feature_name_characters"),
        (event(feature_name="___"), "feature_name_characters"),
        (event(feature_name="Rolling_7d_spend"), "feature_name_case"),
        (event(value=...), "value_missing"),
        (event(value=None), "value_type"),
        (event(value={"a": 1}), "value_type"),
        (event(value=[1]), "value_type"),
        (event(timestamp="yesterday"), "timestamp_invalid"),
        (event(timestamp=None), "timestamp_invalid"),
        (event(timestamp=...), "timestamp_invalid"),
        (event(source=3), "source_type"),
        (event(schema_version=None), "schema_version_type"),
        (event(metadata=[1]), "metadata_type"),
    ],
)
def test_rejected(spark, text, error):
    (row,) = parse(spark, text).collect()
    assert row.error == error


@pytest.mark.parametrize("tail", [" x", "}", "]", ',{"a":1}', ',5', '], [', '},"z":1', " {}"])
@pytest.mark.parametrize("whole", [event(), event(metadata={"a": {"b": "}"}}), event(value="}]")])
def test_anything_behind_the_object_is_malformed(spark, whole, tail):
    good, bad = parse(spark, whole, whole + tail).orderBy("offset").collect()
    assert (good.error, bad.error) == (None, "malformed_json")


def test_repeated_key_takes_its_last_value(spark):
    twice = event(metadata={"a": "b"})[:-1] + ',"value":2}'
    (row,) = parse(spark, twice).collect()
    assert (row.error, row.value_raw) == (None, "2")


def test_letters_of_any_script_are_fine(spark):
    (row,) = parse(spark, event(feature_name="größe_2")).collect()
    assert row.error is None


def test_timestamps(spark):
    stamps = ["2024-01-01T12:00:00", "2024-01-01T12:00:00+02:00", 1704110400, 1704110400500, "2024-01-01T12:00:00.123456Z"]
    rows = parse(spark, *[event(timestamp=s) for s in stamps]).orderBy("offset").select(F.col("event_ts").cast("timestamp_ntz")).collect()
    assert [r[0] for r in rows] == [
        datetime(2024, 1, 1, 12),
        datetime(2024, 1, 1, 10),
        datetime(2024, 1, 1, 12),
        datetime(2024, 1, 1, 12, 0, 0, 500_000),
        datetime(2024, 1, 1, 12, 0, 0, 123_456),
    ]


def test_missing_timestamp_takes_the_arrival(spark):
    (row,) = parse(spark, event(timestamp=...), received_at="2024-05-05 00:00:00").select(
        "error", F.col("event_ts").cast("timestamp_ntz")
    ).collect()
    assert row[0] is None and row[1] == datetime(2024, 5, 5)


def test_bytes(spark):
    df = spark.createDataFrame([(bytearray(GOOD.encode()),), (bytearray(b"\xff\xfe"),)], "value binary")
    assert sorted((r.error or "") for r in msg.parse_messages(df).collect()) == ["", "not_utf8"]
    (dead,) = msg.dead_letters(msg.parse_messages(df)).collect()
    assert (dead.raw_preview, bytes(dead.raw_value)) == ("//4=", b"\xff\xfe")


def test_dead_letters_keep_context_and_whole_message(spark):
    long = "x" * 500
    parsed = parse(spark, GOOD, long)
    (dead,) = msg.dead_letters(parsed).collect()
    assert (dead.offset, dead.error, dead.raw_preview, dead.raw_value) == (1, "malformed_json", "x" * 200, long)
    assert msg.valid_events(parsed).count() == 1


def test_round_trip_through_files(spark, tmp_path):
    texts = [event(value=v, source="s", metadata={"a": "b"}) for v in (5, 5.25, "5", True)]
    events = msg.valid_events(parse(spark, *texts))
    write_messages(msg.to_messages(events), str(tmp_path / "out"))
    lines = spark.read.text(str(tmp_path / "out")).select(F.from_json("value", "key string, value string").alias("m")).select("m.*")
    back = msg.valid_events(msg.parse_messages(lines))
    columns = ["entity_id", "feature_name", "value_raw", "value_type", "event_ts", "source", "schema_version"]
    assert back.select(*columns).exceptAll(events.select(*columns)).isEmpty()
    assert back.count() == 4 and {r.key for r in back.select("key").collect()} == {"e"}


@pytest.mark.parametrize(
    ("entity", "feature", "error"),
    [
        ("customer-1_a.b", "f_1", None),
        ("a:b", "f", "entity_id"),
        ("a\r\nb", "f", "entity_id"),
        ("a\n", "f", "entity_id"),
        ("a" * 129, "f", "entity_id"),
        ("", "f", "entity_id"),
        (None, "f", "entity_id"),
        ("a" * 128, "f" * 64, None),
        ("a", "BadFeature", "feature_name"),
        ("a", "f" * 65, "feature_name"),
    ],
)
def test_lookup_keys(spark, entity, feature, error):
    df = spark.createDataFrame([(entity, feature)], "e string, f string")
    assert df.select(msg.lookup_key_error(F.col("e"), F.col("f"))).first()[0] == error
