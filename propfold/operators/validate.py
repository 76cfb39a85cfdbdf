"""Validate events against the declared types of their properties."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propfold.functions.names import with_identifier
from propfold.functions.values import refusal
from propfold.operators.clean import RECIPES, recipe
from propfold.operators.fold import accepted, fold, registered, with_declared
from propfold.operators.registry import EventType, declared_table, property_spellings, with_event_type
from propfold.sources.schemas import INVALID, VALID


def conformance(events: DataFrame, folded: DataFrame, types: list[EventType]) -> DataFrame:
    """Event types with observed properties: are all of those registered?

    An event type without any observed property has no row.
    """
    typed = with_declared(with_event_type(events.select("id", "name"), types), types)
    return (
        typed.join(folded, typed["id"] == folded["event_id"])
        .groupBy("type_id", "schema")
        .agg(F.bool_and(registered(types)).alias("conforms"))
    )


def schema_conformance(
    events: DataFrame, properties: DataFrame, types: list[EventType]
) -> DataFrame:
    return conformance(events, fold(properties, types, verdicts=True), types)


def judge(
    events: DataFrame, folded: DataFrame, types: list[EventType], gate: bool | DataFrame
) -> DataFrame:
    """Unmigrated events of the given types, joined with ``folded`` and judged.

    With ``gate``, event types with an unregistered property, or with no
    property at all, are left out as a whole. A gate that is kept from run to run
    (``type_id``, ``conforms``) may be given instead.
    """
    pending = with_declared(with_event_type(events.where(~F.col("migrated")), types), types)
    if gate is not False:
        found = conformance(events, folded, types) if gate is True else gate
        open_types = found.where("conforms").select("type_id")
        # At most one row per event type of the registry.
        pending = pending.join(F.broadcast(open_types), "type_id", "left_semi")
    passed = F.col("event_id").isNull() | accepted(types)
    return pending.join(folded, pending["id"] == folded["event_id"], "left").withColumn(
        "valid", F.when(passed, VALID).otherwise(INVALID)
    )


def validate_events(
    events: DataFrame,
    properties: DataFrame,
    types: list[EventType],
    schema_gate: bool | DataFrame = True,
) -> DataFrame:
    """Verdict on each pending event: ``id``, ``schema``, ``valid``."""
    folded = fold(properties, types, verdicts=True)
    return judge(events, folded, types, schema_gate).select("id", "schema", "valid")


def with_verdicts(events: DataFrame, verdicts: DataFrame) -> DataFrame:
    """All events; those judged carry their verdict in ``valid``."""
    found = verdicts.select("id", F.col("valid").alias("_valid"))
    return (
        events.join(found, "id", "left")
        .withColumn("valid", F.coalesce("_valid", "valid"))
        .select(*events.columns)
    )


def refused_properties(
    events: DataFrame, properties: DataFrame, types: list[EventType], recipes: bool = False
) -> DataFrame:
    """Property rows for which a pending event is refused, each with its reason.

    The join by event id is followed by no grouping, so adaptive execution may
    split the rows of one event over several tasks.
    """
    pending = with_event_type(events.where(~F.col("migrated")), types)
    pending = pending.select(F.col("id").alias("event_id"), "type_id", "schema")
    named = with_identifier(properties, "name", "property", property_spellings(types))
    value = F.col("value")
    for declared in RECIPES if recipes else ():
        value = F.when(F.col("type") == declared, recipe(declared)(F.col("value"))).otherwise(value)
    reason = F.when(F.col("type").isNull(), "unregistered").otherwise(refusal(value, F.col("type")))
    return (
        named.join(pending, "event_id")
        .join(F.broadcast(declared_table(events, types)), ["type_id", "property"], "left")
        .withColumn("reason", reason)
        .where(F.col("reason").isNotNull())
        .select("event_id", "schema", F.col("id").alias("property_id"), "name", "value", "reason")
    )
