"""The registry of feature definitions as a table and its changes.

Columns: ``feature_name, description, owner, expected_freshness_seconds,
value_type, is_active, created_at, updated_at``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of a definition.
VALUE_TYPES = ["float", "int", "str", "bool"]
EDITABLE = ["description", "owner", "expected_freshness_seconds", "value_type", "is_active"]
DEFAULTS = {"description": "", "expected_freshness_seconds": 60, "value_type": "float", "is_active": True}
MAX_NAME_LENGTH = 255

SCHEMA = (
    "feature_name string, description string, owner string, expected_freshness_seconds int, "
    "value_type string, is_active boolean, created_at timestamp, updated_at timestamp"
)

# The definitions a new registry starts with.
SEED = [
    ("rolling_7d_spend", "Sum of customer spend over past 7 days", "ml-platform", 45, "float"),
    ("order_count_24h", "Number of orders placed in the past 24 hours", "ml-platform", 60, "int"),
    ("avg_basket_size", "Average basket size over last 30 orders", "ml-platform", 90, "float"),
    ("days_since_last_order", "Days elapsed since most recent order", "ml-platform", 120, "float"),
    ("preferred_category", "Most frequently purchased product category", "ml-platform", 300, "str"),
]


def list_definitions(definitions: DataFrame, active_only: bool = True) -> DataFrame:
    return definitions.filter("is_active") if active_only else definitions


def change_error(changes: DataFrame) -> Column:
    """Why a change row is refused, NULL if it is fine.

    Changes carry ``op`` (create, update, upsert or delete), the key and the
    new values; a NULL value leaves the field as it is.
    """
    op = F.col("op")
    named = F.coalesce(F.length("feature_name").between(1, MAX_NAME_LENGTH), F.lit(False))
    return (
        F.when(~F.coalesce(op.isin("create", "update", "upsert", "delete"), F.lit(False)), "op")
        .when(~named, "feature_name")
        .when(op.isin("create", "upsert") & F.col("owner").isNull(), "owner")
        .when(F.col("expected_freshness_seconds") <= 0, "expected_freshness_seconds")
        .when(~F.col("value_type").isin(VALUE_TYPES), "value_type")
    )


def conflicts(definitions: DataFrame, creates: DataFrame) -> DataFrame:
    """Rows to be created whose name is taken, also by an inactive definition."""
    return creates.join(definitions.select("feature_name"), "feature_name", "left_semi")


def unknown_updates(definitions: DataFrame, updates: DataFrame) -> DataFrame:
    """Updates of names the registry does not have."""
    return updates.join(definitions.select("feature_name"), "feature_name", "left_anti")


def _judged(definitions: DataFrame, changes: DataFrame, order: list[str]) -> DataFrame:
    """Valid changes with ``__at`` (their place) and what each meets there.

    A name once known stays known, since deleting only clears ``is_active``.
    So a change meets a known name if the registry has it, or if a create or
    an upsert of it came before; the first of these adds it.
    """
    valid = changes.filter(change_error(changes).isNull()).withColumn("__at", F.struct(*order))
    adding = valid.filter(F.col("op").isin("create", "upsert")).groupBy("feature_name").agg(F.min("__at").alias("__first"))
    known = definitions.select("feature_name", F.lit(True).alias("__stored"))
    stored = F.coalesce("__stored", F.lit(False))
    return (
        valid.join(known, "feature_name", "left")
        .join(adding, "feature_name", "left")
        .withColumn("__known", stored | F.coalesce(F.col("__at") > F.col("__first"), F.lit(False)))
        .withColumn("__adds", ~stored & F.coalesce(F.col("__at") == F.col("__first"), F.lit(False)))
    )


def refused_changes(definitions: DataFrame, changes: DataFrame, order: list[str]) -> DataFrame:
    """Valid changes that change nothing where they stand, with a ``reason``.

    ``taken``: creates a name that is known by then; ``unknown``: updates or
    deletes one that is not.
    """
    known, op = F.col("__known"), F.col("op")
    reason = F.when(known & (op == "create"), "taken").when(~known & op.isin("update", "delete"), "unknown")
    return (
        _judged(definitions, changes, order).withColumn("reason", reason).filter("reason IS NOT NULL").select(*changes.columns, "reason")
    )


def merge_definitions(definitions: DataFrame, changes: DataFrame, order: list[str], changed_at: str) -> DataFrame:
    """The registry after all valid changes, applied one after the other.

    ``order`` must be different for any two changes of a name. Refused changes
    (see ``refused_changes``) do nothing. An update or upsert sets the fields
    it gives and leaves the others; an upsert also revives a deleted
    definition. Deleting only clears ``is_active``. ``created_at`` stays,
    ``updated_at`` is the time of the last change that was applied.

    Of every field only the last value that was given counts, so the changes
    of a name are reduced to one row by aggregates, however many they are.
    """
    op = F.col("op")
    judged = _judged(definitions, changes, order)
    applied = judged.filter(F.col("__adds") | (F.col("__known") & (op != "create")))
    given = {n: F.when(op != "delete", F.col(n)) for n in EDITABLE}
    given["is_active"] = (
        F.when(op == "delete", False)
        .when((op == "upsert") | F.col("__adds"), F.coalesce("is_active", F.lit(True)))
        .otherwise(F.col("is_active"))
    )

    def last(value: Column) -> Column:
        return F.max(F.when(value.isNotNull(), F.struct(F.col("__at"), value.alias("value"))))["value"]

    changed = applied.groupBy("feature_name").agg(
        F.struct(
            *[last(v).alias(n) for n, v in given.items()],
            F.min_by(changed_at, "__at").alias("first_at"),
            F.max_by(changed_at, "__at").alias("last_at"),
        ).alias("c")
    )
    old = definitions.select("feature_name", F.struct(*[c for c in definitions.columns if c != "feature_name"]).alias("d"))
    both = old.join(changed, "feature_name", "full_outer")
    return both.select(
        "feature_name",
        *[
            F.coalesce(f"c.{n}", F.when(F.col("d").isNull(), F.lit(DEFAULTS.get(n))).otherwise(F.col(f"d.{n}"))).alias(n)
            for n in EDITABLE
        ],
        F.when(F.col("d").isNull(), F.col("c.first_at")).otherwise(F.col("d.created_at")).alias("created_at"),
        F.coalesce("c.last_at", "d.updated_at").alias("updated_at"),
    )
