"""Find event names and property names that the registry lacks."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from propfold.functions.names import identifier
from propfold.functions.values import VARCHAR
from propfold.operators.fold import batches, fold_known, known_at_place
from propfold.operators.registry import MAX_DECLARED
from propfold.operators.sizing import attach
from propfold.sources.schemas import DB_STATUS, MIGRATE_STATUS


ID_PARTS = 16


def new_id(registry: DataFrame, first: str, *ties: str) -> Column:
    """Free ids for new registry rows, numbered by the row they were first seen in.

    They are dealt in ``ID_PARTS`` parts by the remainder of that row's id, each numbered
    by itself: no task sorts all, and ids grow with the number of names, not with the ids
    of the facts.
    """
    part = F.pmod(first, F.lit(ID_PARTS))
    place = F.row_number().over(Window.partitionBy(part).orderBy(first, *ties)) - 1
    return next_id(registry) + part + ID_PARTS * place.cast("long")


def next_id(registry: DataFrame) -> Column:
    """One more than the highest id of the registry."""
    top = registry.select((F.coalesce(F.max("id"), F.lit(-1)) + 1).alias("next"))
    return top.scalar()


def stamps(run_ts: datetime) -> list[Column]:
    moment = F.lit(run_ts.isoformat(" ")).cast("timestamp_ntz")
    return [moment.alias("created_at"), moment.alias("updated_at")]


def statuses() -> list[Column]:
    return [
        F.lit(DB_STATUS["create_pending"]).alias("db_status"),
        F.lit(MIGRATE_STATUS["db_pending"]).alias("migrate_status"),
    ]


def spellings(events: DataFrame) -> DataFrame:
    """Distinct raw event names with their identifier and first event."""
    return (
        events.where(F.col("name").isNotNull())
        .groupBy(F.col("name").alias("help_name"))
        .agg(F.min("id").alias("first_event"))
        .withColumn("clean", identifier("help_name"))
    )


def discover_event_schemas(events: DataFrame, schemas: DataFrame, run_ts: datetime) -> DataFrame:
    """Registry rows for event names known neither by identifier nor as spelt.

    Known names are found by two equality joins, one per column. They are outer
    joins, so that they meet the distinct spellings: an anti join would be moved
    below the grouping, to be made for every event.
    """
    by_name = schemas.select(identifier("name").alias("clean"), F.lit(True).alias("_named"))
    by_spelling = schemas.select("help_name", F.lit(True).alias("_spelt"))
    unknown = (
        spellings(events)
        .join(by_name, "clean", "left")
        .join(by_spelling, "help_name", "left")
        .where(F.col("_named").isNull() & F.col("_spelt").isNull())
    )
    return (
        unknown.groupBy("clean")
        .agg(F.min("help_name").alias("help_name"), F.min("first_event").alias("first_event"))
        .select(
            new_id(schemas, "first_event", "clean").alias("id"),
            F.col("clean").alias("name"),
            "help_name",
            F.lit(None).cast("string").alias("description"),
            *statuses(),
            *stamps(run_ts),
            F.lit(True).alias("is_active"),
            F.lit(False).alias("is_migrated"),
        )
    )


def with_schema_id(events: DataFrame, schemas: DataFrame) -> DataFrame:
    """Events of registered types with ``schema_id``: by identifier, else as spelt."""
    by_name = schemas.groupBy(identifier("name").alias("clean")).agg(F.min("id").alias("_named"))
    by_spelling = (
        schemas.groupBy(F.col("help_name").alias("name"))
        .agg(F.min("id").alias("_spelt"))
        .withColumn("_clean", identifier("name"))
    )
    named = attach(events.select("id", "name"), by_spelling, ["name"], spread="id")
    # Only a spelling that the registry lacks is normalised here.
    named = named.withColumn("clean", F.coalesce("_clean", identifier("name")))
    named = attach(named, by_name, ["clean"], spread="id")
    return named.select("id", F.coalesce("_named", "_spelt").alias("schema_id")).where(
        F.col("schema_id").isNotNull()
    )


def property_spellings(events: DataFrame, properties: DataFrame, schemas: DataFrame) -> DataFrame:
    """Raw property names of each event type, with their first property id."""
    parents = with_schema_id(events, schemas).withColumnRenamed("id", "event_id")
    return (
        properties.where(F.col("name").isNotNull())
        .select("event_id", "id", F.col("name").alias("help_name"))
        .join(parents, "event_id")
        .groupBy("schema_id", "help_name")
        .agg(F.min("id").alias("first_property"))
        .withColumn("clean", identifier("help_name"))
    )


def counted_spellings(counts: DataFrame, schemas: DataFrame) -> DataFrame:
    """``property_spellings`` out of kept counts of observed names.

    An event name is told by the first property id counted with it, which no other has.
    """
    names = counts.groupBy("event_name").agg(F.min("first_property").alias("id"))
    owners = with_schema_id(names.withColumnRenamed("event_name", "name"), schemas)
    owners = owners.join(names, "id").select("event_name", "schema_id")
    return (
        counts.where(F.col("name").isNotNull())
        .join(owners, "event_name")
        .groupBy("schema_id", F.col("name").alias("help_name"))
        .agg(F.min("first_property").alias("first_property"))
        .withColumn("clean", identifier("help_name"))
    )


def discover_properties(
    events: DataFrame,
    properties: DataFrame,
    schemas: DataFrame,
    property_schemas: DataFrame,
    run_ts: datetime,
) -> DataFrame:
    """Registry rows for raw property names not registered under their event type."""
    seen = property_spellings(events, properties, schemas)
    return new_properties(seen, property_schemas, run_ts)


def new_properties(seen: DataFrame, property_schemas: DataFrame, run_ts: datetime) -> DataFrame:
    """Registry rows for those of the spellings seen that the registry lacks.

    A spelling is known when its identifier and the spelling itself are both
    registered. A new spelling of a registered column is an alias: it maps to
    that column and adds none.
    """
    by_name = (
        property_schemas.select(
            F.col("event_id").alias("schema_id"), identifier("name").alias("clean")
        )
        .distinct()
        .withColumn("_has_name", F.lit(True))
    )
    by_spelling = (
        property_schemas.select(F.col("event_id").alias("schema_id"), "help_name")
        .distinct()
        .withColumn("_has_spelling", F.lit(True))
    )
    first = (
        seen.groupBy("schema_id", "clean").agg(F.min("first_property").alias("_first"))
    )
    return (
        seen.join(by_name, ["schema_id", "clean"], "left")
        .join(by_spelling, ["schema_id", "help_name"], "left")
        .where(F.col("_has_name").isNull() | F.col("_has_spelling").isNull())
        .join(first, ["schema_id", "clean"])
        .select(
            new_id(property_schemas, "first_property", "schema_id", "help_name").alias("id"),
            F.col("clean").alias("name"),
            F.col("schema_id").alias("event_id"),
            "help_name",
            F.lit(VARCHAR).alias("type"),
            *statuses(),
            *stamps(run_ts),
            F.lit(True).alias("is_active"),
            (F.col("_has_name").isNotNull() | (F.col("first_property") > F.col("_first"))).alias(
                "is_alias"
            ),
        )
    )


def events_with_new_properties(
    events: DataFrame, properties: DataFrame, schemas: DataFrame, property_schemas: DataFrame
) -> DataFrame:
    """Ids of the events that have a property spelling unknown under their type.

    Only these can add to the registry. They are found by one combining
    aggregation, which shuffles one row per event; the pairs of event type and
    property need then be looked for among few events only. A registry of more than
    ``MAX_DECLARED`` rows is joined to the property rows instead.
    """
    spellings_known = (
        property_schemas.where(F.col("name") == identifier("help_name"))
        .select("event_id", "help_name")
        .distinct()
    )
    type_ids, pairs = bounded(schemas.select("id")), bounded(spellings_known)
    if type_ids is None or pairs is None:
        return unknown_by_join(with_schema_id(events, schemas), properties, spellings_known)
    spelt: dict[int, list[str]] = {row["id"]: [] for row in type_ids}
    for row in pairs:
        spelt.setdefault(row["event_id"], []).append(row["help_name"])
    typed = with_schema_id(events, schemas)
    found = [
        unknown_to(typed, properties, {type_id: spelt[type_id] for type_id in batch})
        for batch in batches(sorted(spelt))
    ]
    return reduce(DataFrame.unionByName, found) if found else typed.select("id").limit(0)


def bounded(rows: DataFrame) -> list[Row] | None:
    """Registry rows brought to the driver; None if they are more than ``MAX_DECLARED``."""
    return rows.collect() if rows.count() <= MAX_DECLARED else None


def unknown_by_join(typed: DataFrame, properties: DataFrame, spelt: DataFrame) -> DataFrame:
    """Events with a property whose spelling is not listed for their type."""
    known = spelt.select(
        F.col("event_id").alias("schema_id"), "help_name", F.lit(True).alias("_known")
    )
    named = properties.where(F.col("name").isNotNull()).select(
        F.col("event_id").alias("id"), F.col("name").alias("help_name")
    )
    seen = attach(named.join(typed, "id"), known, ["schema_id", "help_name"], spread="id")
    return seen.where(F.col("_known").isNull()).select("id").distinct()


def unknown_to(typed: DataFrame, properties: DataFrame, spelt: dict[int, list[str]]) -> DataFrame:
    """Events of the given types with a property not spelt as listed for the type."""
    places = [(type_id, place) for place, type_id in enumerate(spelt)]
    # Broadcast: one row per event type of a batch, all from the driver.
    table = typed.sparkSession.createDataFrame(places, "schema_id long, place int")
    events = typed.join(F.broadcast(table), "schema_id")
    folded = fold_known(properties, list(spelt.values()))
    return (
        events.join(folded, events["id"] == folded["event_id"])
        .where(~known_at_place(len(spelt)))
        .select("id")
    )


def registered_with(registry: DataFrame, new: DataFrame) -> DataFrame:
    """The registry with new rows added, in the columns of the registry."""
    return registry.unionByName(new.select(*registry.columns))
