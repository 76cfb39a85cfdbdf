"""Filters and lookups over the event and user tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IDENTIFIERS = ("email", "mobile_number", "identification")


def pending_events(events: DataFrame, name: str) -> DataFrame:
    """Unmigrated events of one name; an unknown ``migrated`` does not count."""
    return events.where((F.col("name") == name) & ~F.col("migrated"))


def first_by_id(rows: DataFrame, count: int) -> DataFrame:
    """One bounded batch of a run, the same on every run."""
    return rows.orderBy("id").limit(count)


def event_names(events: DataFrame) -> DataFrame:
    return events.select("name").where(F.col("name").isNotNull()).distinct()


def properties_of_events(events: DataFrame, properties: DataFrame) -> DataFrame:
    """Property rows with the name of their event."""
    parents = events.select(F.col("id").alias("event_id"), F.col("name").alias("event_name"))
    return properties.join(parents, "event_id")


def observed_properties(events: DataFrame, properties: DataFrame) -> DataFrame:
    """Property names seen under each event name.

    The join carries names and ids only and may be split by adaptive execution
    where one event has many rows; the grouping that follows has other keys.
    """
    named = properties.select("event_id", F.col("name").alias("property_name"))
    return (
        properties_of_events(events, named)
        .select("event_name", "property_name")
        .where(F.col("event_name").isNotNull() & F.col("property_name").isNotNull())
        .distinct()
    )


def ids_of_events(events: DataFrame, name: str) -> DataFrame:
    return events.where(F.col("name") == name).select(F.col("id").alias("event_id"))


def properties_like(
    events: DataFrame, properties: DataFrame, event_name: str, pattern: str
) -> DataFrame:
    """Properties of the events of one name whose own name matches ``LIKE``."""
    return properties.where(F.col("name").like(pattern)).join(
        ids_of_events(events, event_name), "event_id", "left_semi"
    )


def lacks_identifier() -> Column:
    """E-mail, mobile number or identification is missing."""
    email, mobile, identification = map(F.col, IDENTIFIERS)
    return email.isNull() | mobile.isNull() | identification.isNull()


def has_identifier() -> Column:
    return F.coalesce(*IDENTIFIERS).isNotNull()


def incomplete_users(users: DataFrame) -> DataFrame:
    return users.where(lacks_identifier())


def ids_of_incomplete_users(users: DataFrame) -> DataFrame:
    return incomplete_users(users).select(F.col("id").alias("user_id"))


def user_properties_like(users: DataFrame, properties: DataFrame, pattern: str) -> DataFrame:
    return properties.where(F.col("name").like(pattern)).join(
        ids_of_incomplete_users(users), "user_id", "left_semi"
    )


def identified_users(users: DataFrame) -> DataFrame:
    return users.where(has_identifier())


def users_with_property(properties: DataFrame, name: str) -> DataFrame:
    return properties.where(F.col("name") == name).select("user_id").distinct()


def pending_user_schema(schemas: DataFrame, db_status: str, migrate_status: str) -> DataFrame:
    return schemas.where(
        (F.col("db_status") == db_status) & (F.col("migrate_status") == migrate_status)
    )


def in_registered_schema(
    schemas: DataFrame, property_schemas: DataFrame, schema_name: str
) -> DataFrame:
    """Registry rows of one event type, found by its name."""
    ids = schemas.where(F.col("name") == schema_name).select(F.col("id").alias("event_id"))
    return property_schemas.join(ids, "event_id", "left_semi")
