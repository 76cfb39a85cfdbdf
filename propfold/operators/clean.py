"""Rewrite raw property values within a scope of events or users.

Each function returns the whole property table. Rows whose name is outside the
pattern pass through untouched and unshuffled; only the others are joined.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propfold.functions.names import with_identifier
from propfold.functions.values import DATE, NUMERIC, VARCHAR, integer_text, is_email, replace_text
from propfold.operators.registry import EventType, declared_table, property_spellings, with_event_type

Change = Callable[[Column], Column]


def remove_space(value: Column, scope: str = "all") -> Column:
    return replace_text(value, " ", "", scope)


def comma_to_point(value: Column, scope: str = "all") -> Column:
    return replace_text(value, ",", ".", scope)


def remove_dollar(value: Column, scope: str = "all") -> Column:
    return replace_text(value, "$", "", scope)


def remove_euro(value: Column, scope: str = "all") -> Column:
    return replace_text(value, "€", "", scope)


def swap_text(old: str, new: str = "", scope: str = "all") -> Change:
    return partial(replace_text, old=old, new=new, scope=scope)


def to_integer(value: Column) -> Column:
    return integer_text(value)


def blank(value: Column) -> Column:
    return F.lit(None).cast("string")


# What is cleaned for a property of each declared type.
RECIPES: dict[str, list[Change]] = {
    VARCHAR: [],
    NUMERIC: [remove_space, remove_dollar, remove_euro, comma_to_point],
    DATE: [remove_space],
}


def recipe(declared: str) -> Change:
    def apply(value: Column) -> Column:
        for step in RECIPES.get(declared, []):
            value = step(value)
        return value

    return apply


def change_in_scope(
    properties: DataFrame, owners: DataFrame, pattern: str, column: str, change: Change
) -> DataFrame:
    """Apply ``change`` to ``column`` where name and owner are in scope.

    ``owners`` holds the ids in scope in one column, named like the key of
    ``properties``. They are keys of the event or user table, so each occurs
    once. No grouping stands between that table and the join: adaptive execution
    can then split the rows of an owner that has very many.
    """
    (key,) = owners.columns
    matches = F.col("name").like(pattern)
    outside = properties.where(~F.coalesce(matches, F.lit(False)))
    hits = owners.withColumn("_hit", F.lit(True))
    changed = (
        properties.where(matches)
        .join(hits, key, "left")
        .withColumn(column, F.when(F.col("_hit"), change(F.col(column))).otherwise(F.col(column)))
        .select(*properties.columns)
    )
    return outside.unionByName(changed)


def clean_values(
    properties: DataFrame, owners: DataFrame, pattern: str, change: Change
) -> DataFrame:
    return change_in_scope(properties, owners, pattern, "value", change)


def rename_property(
    properties: DataFrame, owners: DataFrame, pattern: str, new_name: str
) -> DataFrame:
    return change_in_scope(properties, owners, pattern, "name", lambda name: F.lit(new_name))


def email_validity(properties: DataFrame) -> DataFrame:
    """Which distinct values look like an e-mail address."""
    value = F.col("value")
    return (
        properties.where(value.isNotNull())
        .select("value")
        .distinct()
        .withColumn("is_email", is_email(value))
    )


def clean_declared_values(
    events: DataFrame, properties: DataFrame, types: list[EventType]
) -> DataFrame:
    """Apply to each value the recipe of its declared type."""
    owners = with_event_type(events, types).select(F.col("id").alias("event_id"), "type_id")
    declared = declared_table(events, types).withColumnRenamed("type", "_declared")
    value = F.col("value")
    for declared_type in RECIPES:
        changed = recipe(declared_type)(F.col("value"))
        value = F.when(F.col("_declared") == declared_type, changed).otherwise(value)
    named = with_identifier(properties, "name", "property", property_spellings(types))
    return (
        named.join(owners, "event_id", "left")
        .join(F.broadcast(declared), ["type_id", "property"], "left")
        .withColumn("value", value)
        .select(*properties.columns)
    )
