"""Counts of observed names, kept from run to run, and the gate out of them.

A row says how often events spelt ``event_name`` had properties spelt ``name``. Spellings
are kept raw, so a changed registry asks for no property row again: the gate resolves the
few spellings against the registry of the day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propfold.functions.names import with_identifier
from propfold.operators.registry import EventType, declared_table, property_spellings, with_event_type


def observed_counts(events: DataFrame, properties: DataFrame) -> DataFrame:
    """Property rows by event name and property name, both as spelt, with the first id.

    The join is followed by a combining aggregation on other keys, so adaptive execution
    may split the rows of one event.
    """
    parents = events.select(F.col("id").alias("event_id"), F.col("name").alias("event_name"))
    return (
        properties.select("event_id", "id", "name")
        .join(parents, "event_id")
        .groupBy("event_name", "name")
        .agg(F.count("*").alias("n"), F.min("id").alias("first_property"))
    )


def added_counts(counts: DataFrame) -> DataFrame:
    """Counts of several runs as one row for each pair of names."""
    return counts.groupBy("event_name", "name").agg(
        F.sum("n").alias("n"), F.min("first_property").alias("first_property")
    )


def gate(counts: DataFrame, types: list[EventType]) -> DataFrame:
    """Event types with observed properties: are all of those registered?

    Equal to the conformance of the events that were counted.
    """
    observed = counts.where(F.col("n") > 0).select(
        F.col("event_name").alias("name"), F.col("name").alias("_observed")
    )
    typed = with_event_type(observed, types).drop("name")
    named = with_identifier(typed, "_observed", "property", property_spellings(types))
    declared = declared_table(counts, types).select(
        "type_id", "property", F.lit(True).alias("_declared")
    )
    return (
        named.join(F.broadcast(declared), ["type_id", "property"], "left")
        .groupBy("type_id", "schema")
        .agg(F.bool_and(F.col("_declared").isNotNull()).alias("conforms"))
    )
