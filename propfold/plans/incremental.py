"""The whole way of events, run after run, over what is new.

``run_job`` takes in the rows that no earlier run has seen, registers new names, judges
the events that are due, and writes the wide rows of all event types in one job. What it
needs of earlier runs it reads from the store: events that are pending with their property
rows, counts of observed names, the registry. The event and property tables are read
outside the id ranges that are seen, and nowhere else, but for events whose property rows
come late.

Nothing that a run writes is read before its commit, and a run that is repeated overwrites
what it had written, so a run may be killed at any point and started again.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propfold.operators import discover
from propfold.operators.fold import batches
from propfold.operators.observed import added_counts, gate, observed_counts
from propfold.operators.pivot import fold_events
from propfold.operators.registry import EventType, load_event_types
from propfold.operators.sizing import only_of
from propfold.operators.versions import (
    TYPE_PREFIX,
    declared_type,
    read_rows,
    stored_rows,
    stored_struct,
)
from propfold.sources.schemas import VALID
from propfold.sources.seen import islands, unseen
from propfold.sources.store import CURRENT, GROWING, PENDING, SETTLED, Store
from propfold.sources.tables import TenantTables, within_ids


def take_in(store: Store, run_id: int) -> tuple[DataFrame, DataFrame]:
    """Copy the rows that no run has seen, so that all steps of the run see the same ones."""
    taken = []
    for table, name in (("user_event", "events"), ("event_property", "properties")):
        new = unseen(store.tables.read(table), store.growing(f"seen_{name}"))
        new = store.write(f"new_{name}", run_id, new)
        store.write(f"seen_{name}", run_id, islands(new))
        taken.append(new)
    return taken[0], taken[1]


def parents_of(store: Store, events: DataFrame, uncounted: DataFrame) -> DataFrame:
    """Events, as ``id`` and ``name``, that property rows may belong to.

    Those at hand, and for rows that come late those of their id range in the event table
    that earlier runs have seen.
    """
    near = events.select("id", "name")
    late = uncounted.join(near, uncounted["event_id"] == near["id"], "left_anti")
    late = late.select(F.col("event_id").alias("id")).distinct()
    if not store.last or late.isEmpty():
        return near
    table = within_ids(store.tables.read("user_event"), "id", late)
    far = only_of(table, "id", late).join(store.settled().select("id"), "id", "left_semi")
    return near.unionByName(far.select("id", "name"))


def column_log(store: Store, types: list[EventType]) -> DataFrame:
    """Rows for event types whose columns are not those of their last version."""
    known: dict[str, dict[int, set[tuple[str, str]]]] = {}
    for r in store.growing("wide_columns").collect():
        known.setdefault(r["event_type"], {}).setdefault(r["version"], set()).add((r["property"], r["type"]))
    rows = []
    for kind in types:
        versions = known.get(kind.name, {})
        last = max(versions, default=0)
        columns = {(c.property, declared_type(c.type)) for c in kind.columns}
        if columns != versions.get(last, set()):
            rows += [(kind.name, last + 1, *c) for c in sorted(columns)]
    return store.spark.createDataFrame(rows, GROWING["wide_columns"])


def run_job(
    tables: TenantTables,
    run_id: int,
    run_ts: datetime,
    schema_gate: bool = True,
    names: list[str] | None = None,
    recipes: bool = False,
) -> Store:
    """Take in, discover, validate and migrate; returns the store with the run committed.

    Events that were refused are judged again only if a registry has changed since, or new
    property rows of theirs have come; those that were not judged yet always are. A run that
    is committed already does nothing. ``names`` restricts judging to some event types.
    """
    store = Store(tables)
    if run_id in store.runs:
        return store
    if store.last and run_id < store.last.run_id:
        raise ValueError(f"run {run_id} after run {store.last.run_id}")
    new_events, new_properties = take_in(store, run_id)
    waiting = store.pending()
    # Events that the source does not say are to be migrated are settled as they come.
    arrived = new_events.where(~F.col("migrated")).withColumn("valid", F.lit(None).cast("string"))
    done = new_events.where(F.coalesce("migrated", F.lit(True)))
    pending = waiting.unionByName(arrived)

    # Counts of observed names: of new rows, and of rows whose event had not come yet.
    properties = store.current("pending_properties").unionByName(
        new_properties.withColumn("counted", F.lit(False))
    )
    uncounted = properties.where(~F.col("counted"))
    parents = parents_of(store, waiting.unionByName(new_events), uncounted)
    counts = store.write("observed", run_id, observed_counts(parents, uncounted))
    counts = added_counts(store.growing("observed").unionByName(counts))

    # Registries: those of the last run, or of the source, and what they lack.
    before = store.registry() or (tables.read("event_schema"), tables.read("property_event_schema"))
    found = discover.discover_event_schemas(new_events, before[0], run_ts)
    schemas = store.write("event_schema", run_id, discover.registered_with(before[0], found))
    spelt = discover.counted_spellings(counts, schemas)
    found = discover.new_properties(spelt, before[1], run_ts)
    declared = store.write("property_event_schema", run_id, discover.registered_with(before[1], found))
    grown = store.last is None or any(
        now.count() > old.count() for now, old in ((schemas, before[0]), (declared, before[1]))
    )
    changed = grown or store.last.registry > store.last.judged
    types = load_event_types(schemas, declared, names)
    store.write("wide_columns", run_id, column_log(store, types))

    # Judge all at once; write a portion of event types at a time, which bounds the columns.
    due, rest = pending, pending.limit(0)
    if not changed:
        touched = new_properties.select("event_id").join(
            waiting.select(F.col("id").alias("event_id")), "event_id", "left_semi"
        )
        fresh = pending.where("valid is null").select("id")
        fresh = fresh.unionByName(touched.select(F.col("event_id").alias("id"))).distinct()
        due, rest = pending.join(fresh, "id", "left_semi"), pending.join(fresh, "id", "left_anti")
    due_properties = properties.drop("counted").join(
        due.select(F.col("id").alias("event_id")), "event_id", "left_semi"
    )
    opened = gate(counts, types) if schema_gate else False
    folded = fold_events(due, due_properties, types, opened, recipes, any_size=True)
    folded = store.write(f"folded/run={run_id}", 0, folded)
    portions = batches(types) or [types]
    for number, some in enumerate(portions):
        own = F.col("schema").isin(*(kind.name for kind in some)) if len(portions) > 1 else F.lit(True)
        rows = stored_rows(folded.where(own), some, recipes)
        rows.write.mode("overwrite").partitionBy("event_type").parquet(
            f"{store.path('wide', run_id)}/part={number}"
        )

    judged = due.join(folded.select("id", F.col("valid").alias("_valid")), "id", "left")
    judged = judged.withColumn("valid", F.coalesce("_valid", "valid")).withColumn(
        "migrated", F.coalesce(F.col("_valid") == VALID, F.lit(False))
    )
    state = judged.drop("_valid").unionByName(rest).unionByName(done)
    kept = [F.when(~F.col("migrated"), F.col(c)).alias(c) for c in pending.columns if c not in ("id", "valid", "migrated")]
    state = state.select(
        "id", "valid", "migrated", *kept, F.when(~F.col("migrated"), PENDING).otherwise(SETTLED).alias("state")
    )
    state = store.write("event_state", run_id, state.select(*pending.columns, "state"), by="state")
    keep_properties(store, run_id, properties, parents, state)
    if grown:
        return store.commit(run_id, registry=run_id, judged=run_id)
    return store.commit(run_id, judged=run_id)


def keep_properties(
    store: Store, run_id: int, properties: DataFrame, parents: DataFrame, state: DataFrame
) -> None:
    """Property rows that later runs need: those of pending events, and of events to come."""
    owners = state.where(F.col("state") == PENDING).select(F.col("id").alias("event_id"), F.lit(True).alias("_owned"))
    known = parents.select(F.col("id").alias("event_id"), F.lit(True).alias("_known")).distinct()
    kept = (
        properties.join(known, "event_id", "left")
        .join(owners, "event_id", "left")
        .withColumn("counted", F.col("counted") | F.col("_known").isNotNull())
        .where(F.col("_owned").isNotNull() | ~F.col("counted"))
    )
    store.write("pending_properties", run_id, kept.select(*properties.columns))


def change_registry(tables: TenantTables, run_id: int, schemas: DataFrame, declared: DataFrame) -> Store:
    """Put other registries in force, as a run of its own that moves no events."""
    store = Store(tables)
    if run_id in store.runs:
        return store
    if not store.last or run_id < store.last.run_id:
        raise ValueError(f"run {run_id} must follow one that took in events")
    for name, rows in (("event_schema", schemas), ("property_event_schema", declared)):
        before = store.registry()[0 if name == "event_schema" else 1]
        store.write(name, run_id, rows.select(*before.columns))
    carry_over(store, run_id)
    return store.commit(run_id, registry=run_id)


def carry_over(store: Store, run_id: int) -> None:
    """Pending events and their properties, as they are, for the next run to find."""
    pending = store.pending().withColumn("state", F.lit(PENDING))
    store.write("event_state", run_id, pending, by="state")
    store.write("pending_properties", run_id, store.current("pending_properties"))


def compact_job(tables: TenantTables, run_id: int) -> Store:
    """Gather what runs have added into one run, so that later ones read its files only.

    Flags are one row an event before and after; counts are added up, islands joined within
    their block, and of the columns of each event type all versions are kept.
    """
    store = Store(tables)
    if run_id in store.runs:
        return store
    if not store.last or run_id < store.last.run_id:
        raise ValueError(f"run {run_id} must follow one that took in events")
    pending = store.pending().withColumn("state", F.lit(PENDING))
    settled = store.settled().withColumn("state", F.lit(SETTLED))
    both = pending.unionByName(settled, allowMissingColumns=True).select(*pending.columns)
    store.write("event_state", run_id, both, by="state")
    store.write("pending_properties", run_id, store.current("pending_properties"))
    store.write("observed", run_id, added_counts(store.growing("observed")))
    store.write("wide_columns", run_id, store.growing("wide_columns"))
    for name in ("seen_events", "seen_properties"):
        store.write(name, run_id, store.growing(name).coalesce(8))
    return store.commit(run_id, base=run_id)


# Reading


def column_history(store: Store, kind: EventType) -> dict[str, set[str]]:
    """The types that each property of an event type has been declared as."""
    rows = store.growing("wide_columns").where(F.col("event_type") == kind.name)
    history: dict[str, set[str]] = {}
    for r in rows.select("property", "type").distinct().collect():
        history.setdefault(r["property"], set()).add(r["type"])
    return history


def wide_table(store: Store, kind: EventType, exact: bool = False) -> DataFrame:
    """Typed wide rows of one event type out of all runs; a partition filter on both.

    With ``exact``, ``exact_numbers`` holds the numbers that their columns round or leave out.
    """
    history = column_history(store, kind)
    schema = stored_struct(kind, history).add("part", "integer").add("event_type", "string")
    rows = store.stored("wide", schema, store.runs)
    return read_rows(rows.where(F.col("event_type") == f"{TYPE_PREFIX}{kind.name}"), kind, history, exact)


def event_types(store: Store, names: list[str] | None = None) -> list[EventType]:
    """The event types of the registry in force."""
    return load_event_types(*store.registry(), names)


def event_flags(store: Store) -> DataFrame:
    """All events of the source with their current flags; those not taken in keep their own."""
    events = store.tables.read("user_event")
    flags = store.flags().select("id", F.col("valid").alias("_valid"), F.col("migrated").alias("_migrated"))
    return (
        events.join(flags, "id", "left")
        .withColumn("valid", F.coalesce("_valid", "valid"))
        .withColumn("migrated", F.coalesce("_migrated", "migrated"))
        .select(*events.columns)
    )
