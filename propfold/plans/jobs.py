"""The jobs of a tenant: read tables, apply operators, write the results.

Every write is repeatable: a job that lost executors, or the driver, may be run
again. Appends leave out rows that are already there.
"""

from __future__ import annotations

from datetime import datetime
from urllib.parse import quote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propfold.operators import clean, discover, users
from propfold.operators.pivot import (
    cells_of,
    fold_events,
    misfits,
    pivot_events,
    pivot_folded,
    ready_events,
)
from propfold.operators.registry import EventType, load_event_types
from propfold.operators.scans import ids_of_events, ids_of_incomplete_users
from propfold.operators.sizing import only_of
from propfold.operators.validate import refused_properties, validate_events
from propfold.session import shared_dir
from propfold.sources.schemas import INVALID, VALID
from propfold.sources.tables import (
    TenantTables,
    append_new,
    current_flags,
    path_exists,
    with_flags,
    within_ids,
    write_snapshot,
)

# Files that staging may write without arranging the rows by type first.
MAX_STAGED_FILES = 100_000


def event_state(tables: TenantTables) -> DataFrame:
    """Events with the flags that earlier runs have given them."""
    events = tables.read("user_event")
    return with_flags(events, tables.read("event_status")) if tables.exists("event_status") else events


def discover_job(tables: TenantTables, out: str, run_ts: datetime) -> tuple[DataFrame, DataFrame]:
    """Write both event registries with all observed names registered."""
    events, properties = tables.read("user_event"), tables.read("event_property")
    schemas = tables.read("event_schema")
    new = discover.discover_event_schemas(events, schemas, run_ts)
    schemas = write_snapshot(discover.registered_with(schemas, new), f"{out}/event_schema")
    declared = tables.read("property_event_schema")
    ids = write_snapshot(
        discover.events_with_new_properties(events, properties, schemas, declared),
        f"{out}/events_with_new_properties",
    )
    found = discover.discover_properties(
        only_of(events, "id", ids), only_of(properties, "event_id", ids), schemas, declared, run_ts
    )
    declared = write_snapshot(
        discover.registered_with(declared, found), f"{out}/property_event_schema"
    )
    return schemas, declared


def status_rows(
    folded: DataFrame, types: list[EventType], kind: EventType, run_id: int, recipes: bool = False
) -> DataFrame:
    """Verdict of each event of one type, and whether its wide row was written."""
    misfit = misfits(kind, cells_of(folded, types, kind, recipes))
    return folded.where(F.col("schema") == kind.name).select(
        F.col("id").alias("event_id"),
        "valid",
        F.when((F.col("valid") == VALID) & ~misfit, True).alias("migrated"),
        F.lit(run_id).cast("long").alias("run_id"),
    )


def few_files(folded: DataFrame, types: int) -> DataFrame:
    """Rows arranged so that staging them by type does not make too many files.

    Each task writes a file for each type. Where that would be too many, the rows
    are rebalanced by type first, at the price of a shuffle; adaptive execution
    splits a type with many rows over several tasks.
    """
    tasks = int(folded.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return folded.hint("rebalance", "schema") if tasks * types > MAX_STAGED_FILES else folded


def migrate_events_job(
    tables: TenantTables,
    types: list[EventType],
    run_id: int,
    schema_gate: bool = True,
    recipes: bool = False,
) -> DataFrame:
    """Validate the pending events of all types and append them to wide tables.

    With ``recipes``, values are cleaned by the recipe of their declared type on the way,
    which takes no further pass; the property table keeps the raw text.

    The property table is folded once for all types and the result is staged in the shared folder, partitioned by type.
    Each wide table then reads its own partition. The loops run over event types,
    not over data. The flags of a type are written after its rows: a run that
    failed in between may be repeated, and its appends leave out what is there.
    """
    spark = tables.spark
    events, properties = event_state(tables), tables.read("event_property")
    if not schema_gate:
        # The gate looks at all properties ever observed; a verdict does not.
        properties = within_ids(properties, "event_id", events.where(~F.col("migrated")))
    folded = fold_events(events, properties, types, schema_gate, recipes)
    staged = f"{shared_dir(spark)}/{tables.tenant}/folded/run={run_id}"
    few_files(folded, len(types)).write.partitionBy("schema").mode("overwrite").parquet(staged)
    folded = spark.read.schema(folded.schema).parquet(staged)
    for kind in types:
        append_new(pivot_folded(folded, types, kind, recipes), tables.wide_path(kind.name))
        status = status_rows(folded, types, kind, run_id, recipes)
        status.write.mode("append").parquet(tables.path("event_status"))
    return tables.read("event_status").where(F.col("run_id") == run_id)


def validate_job(
    tables: TenantTables, types: list[EventType], run_id: int, schema_gate: bool = True
) -> DataFrame:
    """Write the verdict of each pending event, without migrating any."""
    verdicts = validate_events(
        event_state(tables), tables.read("event_property"), types, schema_gate
    )
    status = verdicts.select(
        F.col("id").alias("event_id"),
        "valid",
        F.lit(None).cast("boolean").alias("migrated"),
        F.lit(run_id).cast("long").alias("run_id"),
    )
    status.write.mode("append").parquet(tables.path("event_status"))
    return tables.read("event_status").where(F.col("run_id") == run_id)


def pivot_job(tables: TenantTables, kind: EventType, run_id: int) -> DataFrame:
    """Append the events of one type that an earlier run has found valid."""
    ready = ready_events(event_state(tables), kind)
    properties = within_ids(tables.read("event_property"), "event_id", ready)
    staged = f"{shared_dir(tables.spark)}/{tables.tenant}/ready/run={run_id}"
    rows = pivot_events(ready, properties, kind)
    rows.write.mode("overwrite").parquet(f"{staged}/{quote(kind.name, safe='')}")
    rows = tables.spark.read.schema(kind.struct()).parquet(f"{staged}/{quote(kind.name, safe='')}")
    append_new(rows, tables.wide_path(kind.name))
    status = rows.select(
        F.col("id").alias("event_id"),
        F.lit(None).cast("string").alias("valid"),
        F.lit(True).alias("migrated"),
        F.lit(run_id).cast("long").alias("run_id"),
    )
    status.write.mode("append").parquet(tables.path("event_status"))
    return wide_table(tables, kind)


def clean_events_job(
    tables: TenantTables, event: str, pattern: str, change: clean.Change, out: str
) -> DataFrame:
    """Write the property table with the values of some events cleaned."""
    owners = ids_of_events(tables.read("user_event"), event)
    cleaned = clean.clean_values(tables.read("event_property"), owners, pattern, change)
    return write_snapshot(cleaned, f"{out}/event_property")


def clean_users_job(
    tables: TenantTables, pattern: str, change: clean.Change, out: str
) -> DataFrame:
    """Write the user properties with those of incomplete users cleaned."""
    owners = ids_of_incomplete_users(tables.read("user_company"))
    cleaned = clean.clean_values(tables.read("user_property"), owners, pattern, change)
    return write_snapshot(cleaned, f"{out}/user_property")


def refusals_job(
    tables: TenantTables, types: list[EventType], out: str, recipes: bool = False
) -> DataFrame:
    """Write why each event was refused: its property rows that do not fit.

    Only the refused events and their properties are read into the join.
    """
    refused = current_flags(tables.read("event_status")).where(F.col("valid") == INVALID)
    ids = write_snapshot(refused.select(F.col("event_id").alias("id")), f"{out}/refused_events")
    events = only_of(event_state(tables), "id", ids)
    properties = only_of(within_ids(tables.read("event_property"), "event_id", ids), "event_id", ids)
    return write_snapshot(
        refused_properties(events, properties, types, recipes), f"{out}/refused_properties"
    )


def event_job(
    tables: TenantTables,
    out: str,
    run_id: int,
    run_ts: datetime,
    schema_gate: bool = True,
    names: list[str] | None = None,
    recipes: bool = False,
) -> list[EventType]:
    """Discover, clean (with ``recipes``), validate and migrate: the whole way of an event.

    ``names`` restricts the run to some event types of the registry.
    """
    schemas, declared = discover_job(tables, out, run_ts)
    types = load_event_types(schemas, declared, names)
    migrate_events_job(tables, types, run_id, schema_gate, recipes)
    return types


def user_job(tables: TenantTables, out: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    """Create user columns, promote and consolidate properties, migrate users."""
    people, properties = tables.read("user_company"), tables.read("user_property")
    schemas = users.columns_created(tables.read("property_user_schema"))
    people = users.evolve_user_columns(people, tables.read("property_user_schema"))
    columns = users.declared_columns(schemas, users.to_promote())
    promoted = write_snapshot(
        users.promote_user_properties(people, properties, columns), f"{out}/promoted_users"
    )
    left = write_snapshot(
        users.unpromoted_properties(people, properties, columns), f"{out}/unpromoted_properties"
    )
    outcomes = write_snapshot(users.consolidation(promoted, left, names), f"{out}/consolidation")
    settled = write_snapshot(
        users.consolidated_users(promoted, left, names), f"{out}/consolidated_users"
    )
    rest = write_snapshot(
        users.unconsolidated_properties(left, outcomes), f"{out}/user_property"
    )
    append_new(users.migrate_identified_users(settled), tables.path("user_identificated"))
    return {
        "user_company": write_snapshot(users.flag_migrated_users(settled), f"{out}/user_company"),
        "user_property": rest,
        "property_user_schema": write_snapshot(
            users.promotion_done(schemas), f"{out}/property_user_schema"
        ),
    }


def wide_table(tables: TenantTables, kind: EventType) -> DataFrame:
    """The wide table of one event type; empty before its first migration."""
    path = tables.wide_path(kind.name)
    if not path_exists(tables.spark, path):
        return tables.spark.createDataFrame([], kind.struct())
    return tables.spark.read.schema(kind.struct()).parquet(path)

