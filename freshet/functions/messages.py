"""Feature events as JSON messages: reading, checking, writing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the message format.
DEFAULT_SCHEMA_VERSION = "1.0"
MILLISECONDS_FROM = 2e10  # a numeric timestamp beyond this counts milliseconds
RAW_PREVIEW_LENGTH = 200  # characters (or bytes) of a rejected message kept for diagnosis
ENTITY_ID_PATTERN = r"\A[a-zA-Z0-9_\-.]{1,128}\z"
FEATURE_NAME_PATTERN = r"\A[a-z0-9_]{1,64}\z"

EVENT_COLUMNS = [
    "entity_id",
    "feature_name",
    "value_raw",
    "value_type",
    "event_ts",
    "source",
    "schema_version",
    "metadata",
]


FIELDS = ["entity_id", "feature_name", "value", "timestamp", "source", "schema_version", "metadata"]
_DOCUMENT = f"struct<{', '.join(f'{f}: variant' for f in FIELDS)}, broken: string>"


def _once(value: Column) -> Column:
    """The value, worked out once per row.

    Exploding a one-element array keeps later filters and projections from
    being merged into the expression, where each use would repeat the work.
    """
    return F.explode(F.array(value))


def _ends_there(text: Column) -> Column:
    """Whether nothing follows the first JSON value of the text.

    The parser stops after that value and does not look further. An object
    whose only closing brace is its last character needs no second look. Any
    other text is parsed once more as an array with its length behind it, which
    whatever follows the value would break.
    """
    plain = F.instr(text, "}") == F.char_length(F.rtrim(text))
    array = F.from_json(F.concat(F.lit("["), text, F.lit(","), F.octet_length(text), F.lit("]")), "array<string>")
    both = (F.size(array) == 2) & (F.get(array, F.lit(1)) == F.octet_length(text).cast("string"))
    return F.when(plain, True).otherwise(F.coalesce(both, F.lit(False)))


def _fields(document: str) -> Column:
    """Type and text of every field of a message."""
    columns = []
    for name in FIELDS:
        node = F.col(f"{document}.{name}")
        columns.append(F.schema_of_variant(node).alias(f"{name}_type"))
        if name != "metadata":
            columns.append(F.try_variant_get(node, "$", "string").alias(name))
    metadata = F.try_variant_get(f"{document}.metadata", "$", "map<string,string>")
    return F.struct(*columns, metadata.alias("metadata_map"))


def _value_type(schema: Column) -> Column:
    """Tag of a JSON value that is a number, text or truth value; NULL for anything else."""
    other = schema.startswith("OBJECT") | schema.startswith("ARRAY") | (schema == "VOID")
    return (
        F.when(schema == "STRING", "str")
        .when(schema == "BIGINT", "int")
        .when(schema == "BOOLEAN", "bool")
        .when(~other, "float")
    )


def _timestamp(text: Column, schema: Column) -> Column:
    number = text.try_cast("double")
    seconds = F.when(F.abs(number) > MILLISECONDS_FROM, number / 1000.0).otherwise(number)
    numeric = F.timestamp_micros(F.round(seconds * 1_000_000.0).try_cast("bigint"))
    tag = _value_type(schema)
    return F.when(schema == "STRING", text.try_cast("timestamp")).when(tag.isin("int", "float"), numeric)


def parse_messages(raw: DataFrame, value: str = "value", received_at: str | None = None) -> DataFrame:
    """Adds the event columns and ``error`` (NULL for a valid message).

    ``value`` is text or bytes. A message without a timestamp takes the column
    ``received_at``; without such a column it is rejected, since no operator
    here looks at the wall clock. All other input columns are kept.
    """
    binary = raw.schema[value].dataType.typeName() == "binary"
    text = F.try_validate_utf8(F.col(value).cast("string")) if binary else F.col(value)
    kept = [c for c in raw.columns if c not in EVENT_COLUMNS]
    # one parse per message; each field comes as a node that knows its type
    document = F.from_json(text, _DOCUMENT, {"columnNameOfCorruptRecord": "broken"})
    opened = raw.select(*kept, _once(document).alias("_doc"))
    is_object = F.col("_doc").isNotNull() & F.col("_doc.broken").isNull()
    # only what is no object is looked at again
    is_json = F.when(is_object, True).otherwise(F.try_parse_json(text).isNotNull()) & _ends_there(text)
    opened = opened.select(
        *kept, is_object.alias("_is_object"), is_json.alias("_is_json"), _once(_fields("_doc")).alias("_m")
    )

    def schema(name: str) -> Column:
        return F.col(f"_m.{name}_type")

    def content(name: str) -> Column:
        return F.col(f"_m.{name}")

    event_ts = _timestamp(content("timestamp"), schema("timestamp"))
    if received_at is not None:
        arrival = F.col(received_at).cast("timestamp")
        event_ts = F.when(schema("timestamp").isNull(), arrival).otherwise(event_ts)
    # the parts that cost something, again once per row
    opened = opened.select(
        *kept,
        "_is_object",
        "_is_json",
        "_m",
        _once(
            F.struct(
                event_ts.alias("event_ts"),
                _value_type(schema("value")).alias("value_type"),
                content("entity_id").rlike(r"(?U)\A[\s\x1c-\x1f]*\z").alias("entity_blank"),
                F.replace(content("feature_name"), F.lit("_"), F.lit(""))
                .rlike(r"\A[\p{L}\p{N}]+\z")
                .alias("name_fits"),
            )
        ).alias("_d"),
    )
    error = (
        F.when(F.col(value).isNull(), "empty_message")
        .when(text.isNull(), "not_utf8")
        .when(~F.col("_is_json"), "malformed_json")
        .when(~F.col("_is_object"), "not_an_object")
        .when(schema("entity_id").isNull(), "entity_id_missing")
        .when(schema("entity_id") != "STRING", "entity_id_type")
        .when(F.col("_d.entity_blank"), "entity_id_blank")
        .when(schema("feature_name").isNull(), "feature_name_missing")
        .when(schema("feature_name") != "STRING", "feature_name_type")
        .when(~F.col("_d.name_fits"), "feature_name_characters")
        .when(content("feature_name") != F.lower(content("feature_name")), "feature_name_case")
        .when(schema("value").isNull(), "value_missing")
        .when(F.col("_d.value_type").isNull(), "value_type")
        .when(F.col("_d.event_ts").isNull(), "timestamp_invalid")
        .when(~F.coalesce(schema("source"), F.lit("VOID")).isin("STRING", "VOID"), "source_type")
        .when(F.coalesce(schema("schema_version"), F.lit("STRING")) != "STRING", "schema_version_type")
        .when(~F.coalesce(schema("metadata"), F.lit("VOID")).rlike(r"\A(VOID|OBJECT)"), "metadata_type")
    )
    return opened.select(
        *kept,
        content("entity_id").alias("entity_id"),
        content("feature_name").alias("feature_name"),
        content("value").alias("value_raw"),
        F.col("_d.value_type").alias("value_type"),
        F.col("_d.event_ts").alias("event_ts"),
        content("source").alias("source"),
        F.coalesce(content("schema_version"), F.lit(DEFAULT_SCHEMA_VERSION)).alias("schema_version"),
        F.col("_m.metadata_map").alias("metadata"),
        error.alias("error"),
    )


def valid_events(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error").isNull()).drop("error")


def dead_letters(parsed: DataFrame, value: str = "value") -> DataFrame:
    """Rejected messages: their other columns, the error, a short preview and the whole message."""
    preview = F.substring(F.col(value), 1, RAW_PREVIEW_LENGTH)
    if parsed.schema[value].dataType.typeName() == "binary":
        # bytes that are no text are shown in base 64
        preview = F.coalesce(F.try_validate_utf8(preview.cast("string")), F.base64(preview))
    context = [c for c in parsed.columns if c not in EVENT_COLUMNS + [value, "error"]]
    return parsed.filter(F.col("error").isNotNull()).select(
        *context, "error", preview.alias("raw_preview"), F.col(value).alias("raw_value")
    )


def lookup_key_error(entity_id: Column, feature_name: Column | None = None) -> Column:
    """Why a lookup key is refused, NULL if it is fine."""
    error = F.when(~F.coalesce(entity_id.rlike(ENTITY_ID_PATTERN), F.lit(False)), "entity_id")
    if feature_name is not None:
        error = error.when(~F.coalesce(feature_name.rlike(FEATURE_NAME_PATTERN), F.lit(False)), "feature_name")
    return error


def to_messages(events: DataFrame, key: str | None = None) -> DataFrame:
    """``key, value`` of each event, ready for a keyed topic or a JSON sink.

    ``value`` has the JSON type named by ``value_type``. The key defaults to
    the entity, so the events of an entity keep their order.
    """

    def node(value: Column) -> Column:
        return F.variant_get(F.to_variant_object(F.array(value)), "$[0]", "variant")

    raw, tag = F.col("value_raw"), F.col("value_type")
    body = F.struct(
        "entity_id",
        "feature_name",
        F.when(tag == "str", node(raw))
        .when(tag == "bool", node(raw.cast("boolean")))
        .when(tag == "int", node(raw.cast("bigint")))
        .otherwise(node(raw.cast("double")))
        .alias("value"),
        F.date_format(F.col("event_ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        "source",
        "schema_version",
        "metadata",
    )
    return events.select(
        (F.col(key) if key else F.col("entity_id")).cast("string").alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).alias("value"),
    )
