"""The registered queries: operators over tables derived from the given ones."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propfold.functions import names as n
from propfold.functions import numbers
from propfold.functions import values as v
from propfold.operators import (
    clean,
    discover,
    observed,
    pivot,
    registry,
    scans,
    users,
    validate,
    versions,
    wide_table,
)
from propfold.plans import rewrites
from propfold.session import shared_dir
from propfold.sources import given, parts, seen
from propfold.sources.schemas import table_schema
from propfold.sources.tables import TenantTables, current_flags, only_new, write_snapshot

Query = Callable[[SparkSession, str], DataFrame]

RUN_TS = datetime(2024, 3, 1)
CENTS = "decimal(18,2)"


class Given:
    """The derived tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, table: str) -> DataFrame:
        if table not in given.DERIVED:
            raise AttributeError(table)
        rows = given.DERIVED[table](self.spark, self.folder)
        self.__dict__[table] = rows
        return rows

    def types(self, names: list[str] | None = None) -> list[registry.EventType]:
        return registry.load_event_types(self.event_schema, self.property_event_schema, names)

    def judged_events(self, types: list[registry.EventType] | None = None) -> DataFrame:
        """Events with the verdict each gets on its own."""
        types = self.types() if types is None else types
        verdicts = validate.validate_events(
            self.user_event, self.event_property, types, schema_gate=False
        )
        return validate.with_verdicts(self.user_event, verdicts)


def in_cents(rows: DataFrame) -> DataFrame:
    decimals = [f.name for f in rows.schema if f.dataType.typeName() == "decimal"]
    return rows.withColumns({name: F.col(name).cast(CENTS) for name in decimals})


def scan_pending_events(g: Given) -> DataFrame:
    return scans.pending_events(g.user_event, "PURCHASE")


def pending_events_batch(g: Given) -> DataFrame:
    return scans.first_by_id(scans.pending_events(g.user_event, "PURCHASE"), 200)


def filter_eq(g: Given) -> DataFrame:
    return g.user_property.where(F.col("name") == "nickname")


def filter_like(g: Given) -> DataFrame:
    return g.event_property.where(F.col("name").like("%A_O%"))


def event_property_join(g: Given) -> DataFrame:
    return scans.properties_of_events(g.user_event, g.event_property)


def scan_event_props_like(g: Given) -> DataFrame:
    return scans.properties_like(g.user_event, g.event_property, "PURCHASE", "VALOR_TOTAL")


def scan_user_props_incomplete(g: Given) -> DataFrame:
    return scans.user_properties_like(g.user_company, g.user_property, "CANTIDAD%")


def active_schemas(g: Given) -> DataFrame:
    return registry.active_schemas(g.event_schema)


def schema_columns(g: Given) -> DataFrame:
    return registry.schema_columns(g.event_schema, g.property_event_schema)


def pending_user_schema(g: Given) -> DataFrame:
    return scans.pending_user_schema(
        g.property_user_schema, "create_completed", "migrate_pending"
    )


def identified_users(g: Given) -> DataFrame:
    return scans.identified_users(g.user_company)


def identified_users_batch(g: Given, size: int = 5000) -> DataFrame:
    return scans.first_by_id(scans.identified_users(g.user_company), size)


def identified_users_small_batch(g: Given) -> DataFrame:
    return identified_users_batch(g, 50)


def incomplete_users(g: Given) -> DataFrame:
    return scans.incomplete_users(g.user_company)


def users_with_property(g: Given) -> DataFrame:
    return scans.users_with_property(g.user_property, "identification_type")


def distinct_event_names(g: Given) -> DataFrame:
    return scans.event_names(g.user_event)


def observed_properties(g: Given) -> DataFrame:
    return scans.observed_properties(g.user_event, g.event_property)


def semi_event_ids(g: Given) -> DataFrame:
    owners = scans.ids_of_events(g.user_event, "PURCHASE")
    return g.event_property.join(owners, "event_id", "left_semi")


def semi_schema_properties(g: Given) -> DataFrame:
    return scans.in_registered_schema(g.event_schema, g.property_event_schema, "purchase")


def ready_events(g: Given) -> DataFrame:
    return pivot.ready_events(g.judged_events()).select("id", "name", "valid", "migrated")


def ready_events_batch(g: Given, size: int = 100_000) -> DataFrame:
    return scans.first_by_id(ready_events(g), size)


def ready_events_small_batch(g: Given) -> DataFrame:
    return ready_events_batch(g, 100)


def normalize_names(g: Given) -> DataFrame:
    raw = g.user_event.select("name").union(g.event_property.select("name")).distinct()
    return raw.select(
        "name", n.identifier("name").alias("identifier"), n.comparison_key("name").alias("key")
    )


def normalize_texts(g: Given) -> DataFrame:
    return given.table(g.spark, g.folder, "documents").select(
        "doc_id", n.identifier("text").alias("identifier"), n.comparison_key("text").alias("key")
    )


def read_types(g: Given) -> DataFrame:
    value = F.col("value")
    return g.event_property.select(
        "id",
        v.as_integer(value).alias("as_integer"),
        v.as_numeric(value).cast(CENTS).alias("as_numeric"),
        v.as_date(value).alias("as_date"),
        v.as_varchar(value).alias("as_varchar"),
    )


def scaled_numbers(g: Given) -> DataFrame:
    """Amounts of event properties, written with signs and powers of ten from their event id."""
    sign = F.when(F.pmod("event_id", F.lit(2)) == 1, "-").otherwise("")
    power = (F.pmod("event_id", F.lit(61)) - 30).cast("string")
    rows = g.event_property.where(F.col("value").rlike(r"^[0-9]+[.][0-9]{2}\z"))
    return rows.select("id", "name", F.concat(sign, "value", F.lit("e"), power).alias("value"))


def exact_numbers(g: Given) -> DataFrame:
    number = F.col("number")
    rows = scaled_numbers(g).select("id", numbers.read(F.col("value")).alias("number"))
    return rows.select("id", numbers.text_of(number).alias("exact"), numbers.held_of(number).alias("held"))


def exact_number_ranges(g: Given) -> DataFrame:
    """Least and greatest number of each property name, in exact order."""
    rows = scaled_numbers(g).select("name", numbers.read(F.col("value")).alias("number"))
    keyed = F.struct(
        numbers.key_of(F.col("number")).alias("key"), numbers.text_of(F.col("number")).alias("text")
    )
    return rows.select("name", keyed.alias("number")).groupBy("name").agg(
        F.count("*").alias("n"),
        F.min("number")["text"].alias("least"),
        F.max("number")["text"].alias("greatest"),
    )


def discover_event_schemas(g: Given) -> DataFrame:
    return discover.discover_event_schemas(g.user_event, g.event_schema, RUN_TS)


def discover_properties(g: Given) -> DataFrame:
    return discover.discover_properties(
        g.user_event, g.event_property, g.event_schema, g.property_event_schema, RUN_TS
    )


def events_with_new_properties(g: Given) -> DataFrame:
    return discover.events_with_new_properties(
        g.user_event, g.event_property, g.event_schema, g.property_event_schema
    )


def validate_events(g: Given) -> DataFrame:
    return validate.validate_events(g.user_event, g.event_property, g.types(), schema_gate=False)


def validate_events_gated(g: Given) -> DataFrame:
    return validate.validate_events(g.user_event, g.event_property, g.types())


def schema_conformance(g: Given) -> DataFrame:
    return validate.schema_conformance(g.user_event, g.event_property, g.types())


def observed_counts(g: Given) -> DataFrame:
    return observed.observed_counts(g.user_event, g.event_property)


def kept_counts(g: Given) -> DataFrame:
    """Counts of observed names as three runs would have kept them."""
    parts = [
        observed.observed_counts(g.user_event, g.event_property.where(F.pmod("id", F.lit(3)) == run))
        for run in range(3)
    ]
    return observed.added_counts(parts[0].unionByName(parts[1]).unionByName(parts[2]))


def schema_conformance_kept(g: Given) -> DataFrame:
    return observed.gate(kept_counts(g), g.types())


def validate_events_kept_gate(g: Given) -> DataFrame:
    types = g.types()
    gate = observed.gate(kept_counts(g), types)
    return validate.validate_events(g.user_event, g.event_property, types, gate)


def discover_properties_kept(g: Given) -> DataFrame:
    spelt = discover.counted_spellings(kept_counts(g), g.event_schema)
    return discover.new_properties(spelt, g.property_event_schema, RUN_TS)


def seen_islands(g: Given) -> DataFrame:
    return seen.islands(g.event_property)


def unseen_properties(g: Given) -> DataFrame:
    """Property rows that are new to a run before which those of every third event had come."""
    there = g.event_property.where(F.pmod("event_id", F.lit(3)) == 0)
    path = f"{shared_dir(g.spark)}/islands-{uuid.uuid4().hex}"
    return seen.unseen(g.event_property, write_snapshot(seen.islands(there), path))


def wide_over_versions(g: Given) -> DataFrame:
    """Purchases of which the first half was stored when all properties were declared as text."""
    (kind,) = g.types(["purchase"])
    text = replace(kind, columns=tuple(replace(c, type=v.VARCHAR) for c in kind.columns))
    folded = pivot.fold_events(g.user_event, g.event_property, [kind], schema_gate=False)
    early = F.col("created_at") < F.lit("2024-01-16").cast("timestamp_ntz")
    stored = versions.stored_rows(folded.where(early), [text]).unionByName(
        versions.stored_rows(folded.where(~early), [kind]), allowMissingColumns=True
    )
    history = {c.property: {v.VARCHAR, c.type} for c in kind.columns}
    return in_cents(versions.read_rows(stored, kind, history))


def refused_properties(g: Given) -> DataFrame:
    return validate.refused_properties(g.user_event, g.event_property, g.types())


def validated_and_pivoted(g: Given, name: str) -> DataFrame:
    """Verdicts and cells of one type out of one aggregation of the properties."""
    types = g.types([name])
    folded = pivot.fold_events(g.user_event, g.event_property, types, schema_gate=False)
    return in_cents(pivot.pivot_folded(folded, types, types[0]))


def pivot_events(g: Given) -> DataFrame:
    return validated_and_pivoted(g, "purchase")


def pivot_documents(g: Given) -> DataFrame:
    return validated_and_pivoted(g, "documento_leido")


def pivot_orders(g: Given) -> DataFrame:
    return validated_and_pivoted(g, "pedido_f")


def pivot_ready_events(g: Given) -> DataFrame:
    """Wide rows of events that carry their verdict already."""
    (kind,) = g.types(["purchase"])
    return in_cents(pivot.pivot_events(g.judged_events([kind]), g.event_property, kind))


def pivot_events_incremental(g: Given) -> DataFrame:
    """Rows to append when the rows of the first half of January are there."""
    wide = pivot_events(g)
    there = wide.where(F.col("created_at") < F.lit("2024-01-16").cast("date"))
    return only_new(wide, there)


def misfit_cells(g: Given) -> DataFrame:
    """Cells that would not fit if nothing had been validated."""
    (kind,) = g.types(["purchase"])
    events = g.user_event.withColumn("valid", F.lit("validated"))
    return pivot.misfit_cells(events, g.event_property, kind)


def pivot_all_schemas(g: Given) -> DataFrame:
    types = g.types()
    folded = pivot.fold_events(g.user_event, g.event_property, types, schema_gate=False)
    return pivot.cell_text(folded, types)


def pipeline_all_schemas(g: Given) -> DataFrame:
    """Typed rows of all event types: cleaned by recipe, validated and pivoted."""
    types = g.types()
    folded = pivot.fold_events(g.user_event, g.event_property, types, schema_gate=False, recipes=True)
    return in_cents(pivot.typed_rows(folded, types, recipes=True))


def mark_migrated(g: Given) -> DataFrame:
    events = g.judged_events()
    done = pivot.ready_events(events).select("id")
    return users.mark_migrated(events, done).select("id", "name", "valid", "migrated")


def event_flags(g: Given) -> DataFrame:
    """Latest flags out of three runs, of which some leave a flag open."""
    events = g.user_event
    moved = F.col("migrated").alias("migrated")
    none, open_ = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    early = F.col("created_at") < F.lit("2024-01-16").cast("timestamp_ntz")
    runs = [
        (F.when(early, "unvalid").alias("valid"), open_.alias("migrated")),
        (F.lit("validated").alias("valid"), moved),
        (none.alias("valid"), F.when(early, True).alias("migrated")),
    ]
    event_id = F.col("id").alias("event_id")
    status = None
    for run_id, flags in enumerate(runs):
        rows = events.select(event_id, *flags, F.lit(run_id).cast("long").alias("run_id"))
        status = rows if status is None else status.unionByName(rows)
    return current_flags(status)


def wide_table_schema(g: Given) -> DataFrame:
    return wide_table.wide_table_schema(g.event_schema, g.property_event_schema)


def missing_wide_columns(g: Given) -> DataFrame:
    """Columns which the table of purchases would lack if it were that of signups."""
    columns = wide_table_schema(g)
    wanted = columns.where(F.col("schema") == "purchase").select("column_name", "data_type")
    return wide_table.missing_columns(wanted, columns.where(F.col("schema") == "signup"))


def clean_event(change: clean.Change, event: str = "PURCHASE", pattern: str = "VALOR%") -> Callable:
    def query(g: Given) -> DataFrame:
        owners = scans.ids_of_events(g.user_event, event)
        return clean.clean_values(g.event_property, owners, pattern, change)

    return query


def clean_user(change: clean.Change, pattern: str) -> Callable:
    def query(g: Given) -> DataFrame:
        owners = scans.ids_of_incomplete_users(g.user_company)
        return clean.clean_values(g.user_property, owners, pattern, change)

    return query


def remove_first_space(value):
    return clean.remove_space(value, scope="first")


def in_parts(g: Given, table: str) -> parts.NamedParts:
    """A derived property table, stored in parts in a folder of its own below the shared one."""
    tables = TenantTables(g.spark, f"{shared_dir(g.spark)}/parts-{uuid.uuid4().hex}", "given")
    for name in ("user_event", "user_company"):
        getattr(g, name).write.parquet(tables.path(name))
    stored = parts.NamedParts(tables, table)
    rows = getattr(g, table)
    fields = [
        (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in table_schema(table)
    ]
    stored.write(1, rows.select(*fields))
    return stored


def clean_in_parts(g: Given) -> DataFrame:
    """The whole table after a change that has rewritten the parts it touches."""
    stored = in_parts(g, "event_property")
    rewrites.clean_job(stored, "VALOR%", clean.remove_dollar, 2, "PURCHASE")
    return stored.read().select(*g.event_property.columns)


def rename_in_parts(g: Given) -> DataFrame:
    stored = in_parts(g, "user_property")
    rewrites.rename_job(stored, "CANTIDAD%", "cantidad_cortesia", 2)
    return stored.read().select(*g.user_property.columns)


def rename_user_property(g: Given) -> DataFrame:
    owners = scans.ids_of_incomplete_users(g.user_company)
    return clean.rename_property(g.user_property, owners, "CANTIDAD%", "cantidad_cortesia")


def clean_declared_values(g: Given) -> DataFrame:
    return clean.clean_declared_values(g.user_event, g.event_property, g.types())


def email_validity(g: Given) -> DataFrame:
    scope = scans.properties_like(g.user_event, g.event_property, "PURCHASE", "Correo%")
    return clean.email_validity(scope)


def email_validity_texts(g: Given) -> DataFrame:
    scope = scans.properties_like(g.user_event, g.event_property, "Documento Leído", "Texto")
    return clean.email_validity(scope)


def email_validity_user(g: Given) -> DataFrame:
    return clean.email_validity(scans.user_properties_like(g.user_company, g.user_property, "%"))


def evolve_user_columns(g: Given) -> DataFrame:
    return in_cents(users.evolve_user_columns(g.user_company, g.property_user_schema))


def user_schema_status(g: Given) -> DataFrame:
    return users.promotion_done(users.columns_created(g.property_user_schema))


def waiting_columns(g: Given) -> dict[str, str]:
    return users.declared_columns(g.property_user_schema, users.to_promote())


def promote_user_properties(g: Given) -> DataFrame:
    return users.promote_user_properties(g.user_company, g.user_property, waiting_columns(g))


def remaining_user_props(g: Given) -> DataFrame:
    return users.unpromoted_properties(g.user_company, g.user_property, waiting_columns(g))


def outcomes(g: Given) -> DataFrame:
    return users.consolidation(g.user_company, g.user_property)


def consolidated_users(g: Given) -> DataFrame:
    return users.consolidated_users(g.user_company, g.user_property)


def unconsolidated_user_props(g: Given) -> DataFrame:
    return users.unconsolidated_properties(g.user_property, outcomes(g))


def migrate_identified_users(g: Given) -> DataFrame:
    """Rows to append when the users of nations 10 and up are there already."""
    there = g.user_company.where(F.col("country").cast("int") >= 10)
    return users.migrate_identified_users(g.user_company, there)


def flag_migrated_users(g: Given) -> DataFrame:
    return users.flag_migrated_users(g.user_company).select("id", "migrate")


REGISTERED: dict[str, Callable[[Given], DataFrame]] = {
    "pivot_events": pivot_events,
    "pivot_documents": pivot_documents,
    "pivot_orders": pivot_orders,
    "pivot_ready_events": pivot_ready_events,
    "pivot_all_schemas": pivot_all_schemas,
    "pivot_events_incremental": pivot_events_incremental,
    "pipeline_all_schemas": pipeline_all_schemas,
    "misfit_cells": misfit_cells,
    "mark_migrated": mark_migrated,
    "event_flags": event_flags,
    "validate_events": validate_events,
    "validate_events_gated": validate_events_gated,
    "schema_conformance": schema_conformance,
    "observed_counts": observed_counts,
    "schema_conformance_kept": schema_conformance_kept,
    "validate_events_kept_gate": validate_events_kept_gate,
    "discover_properties_kept": discover_properties_kept,
    "seen_islands": seen_islands,
    "unseen_properties": unseen_properties,
    "wide_over_versions": wide_over_versions,
    "refused_properties": refused_properties,
    "read_types": read_types,
    "exact_numbers": exact_numbers,
    "exact_number_ranges": exact_number_ranges,
    "normalize_names": normalize_names,
    "normalize_texts": normalize_texts,
    "discover_event_schemas": discover_event_schemas,
    "discover_properties": discover_properties,
    "events_with_new_properties": events_with_new_properties,
    "wide_table_schema": wide_table_schema,
    "missing_wide_columns": missing_wide_columns,
    "scan_pending_events": scan_pending_events,
    "pending_events_batch": pending_events_batch,
    "filter_eq": filter_eq,
    "filter_like": filter_like,
    "event_property_join": event_property_join,
    "scan_event_props_like": scan_event_props_like,
    "scan_user_props_incomplete": scan_user_props_incomplete,
    "active_schemas": active_schemas,
    "schema_columns": schema_columns,
    "pending_user_schema": pending_user_schema,
    "identified_users": identified_users,
    "identified_users_batch": identified_users_batch,
    "identified_users_small_batch": identified_users_small_batch,
    "incomplete_users": incomplete_users,
    "users_with_property": users_with_property,
    "distinct_event_names": distinct_event_names,
    "observed_properties": observed_properties,
    "semi_event_ids": semi_event_ids,
    "semi_schema_properties": semi_schema_properties,
    "ready_events": ready_events,
    "ready_events_batch": ready_events_batch,
    "ready_events_small_batch": ready_events_small_batch,
    "clean_remove_space": clean_event(clean.remove_space, pattern="Correo%"),
    "clean_remove_space_first": clean_event(remove_first_space, pattern="Correo%"),
    "clean_remove_space_user": clean_user(clean.remove_space, "CANTIDAD%"),
    "clean_comma_to_dot_user": clean_user(clean.comma_to_point, "CANTIDAD%"),
    "clean_remove_dollar_user": clean_user(clean.remove_dollar, "CANTIDAD%"),
    "clean_remove_euro_user": clean_user(clean.remove_euro, "CANTIDAD%"),
    "clean_replace_text_user": clean_user(clean.swap_text("example", "correo"), "email"),
    "clean_comma_to_dot": clean_event(clean.comma_to_point),
    "clean_remove_dollar": clean_event(clean.remove_dollar),
    "clean_remove_euro": clean_event(clean.remove_euro),
    "clean_replace_text": clean_event(clean.swap_text("example", "correo"), pattern="Correo%"),
    "clean_cast_integer": clean_event(clean.to_integer),
    "clean_cast_integer_user": clean_user(clean.to_integer, "CANTIDAD%"),
    "clean_declared_values": clean_declared_values,
    "blank_property_value": clean_event(clean.blank, pattern="K"),
    "blank_user_property_value": clean_user(clean.blank, "nick%"),
    "rename_user_property": rename_user_property,
    "clean_in_parts": clean_in_parts,
    "rename_in_parts": rename_in_parts,
    "email_validity": email_validity,
    "email_validity_texts": email_validity_texts,
    "email_validity_user": email_validity_user,
    "evolve_user_columns": evolve_user_columns,
    "user_schema_status": user_schema_status,
    "promote_user_properties": promote_user_properties,
    "remaining_user_props": remaining_user_props,
    "consolidate_user_property": outcomes,
    "consolidated_users": consolidated_users,
    "unconsolidated_user_props": unconsolidated_user_props,
    "migrate_identified_users": migrate_identified_users,
    "flag_migrated_users": flag_migrated_users,
}


def registered() -> dict[str, Query]:
    def over(query: Callable[[Given], DataFrame]) -> Query:
        return lambda spark, folder: query(Given(spark, folder))

    return {name: over(query) for name, query in REGISTERED.items()}
