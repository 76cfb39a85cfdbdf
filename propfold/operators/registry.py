"""The event registry: which event types exist and which columns they declare."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from itertools import groupby
from operator import attrgetter, itemgetter

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propfold.functions.names import KNOWN_LENGTH, identifier, normal_form, with_identifier
from propfold.functions.values import spark_type
from propfold.sources.schemas import BASE_COLUMNS, DB_STATUS

# A registry row is one declared property; a tenant has far fewer than this.
MAX_DECLARED = 100_000

# Spellings of a column that are looked up; others are normalised in place.
KNOWN_SPELLINGS = 16

# Properties that would meet a base column, or the column of such a property.
RESERVED = rf"({'|'.join(BASE_COLUMNS)})(_prop)*"


@dataclass(frozen=True)
class WideColumn:
    property: str
    column: str
    type: str
    spellings: tuple[tuple[str, str], ...] = field(default=(), compare=False)


@dataclass(frozen=True)
class EventType:
    id: int
    name: str
    columns: tuple[WideColumn, ...]
    spellings: tuple[str, ...] = field(default=(), compare=False)

    def struct(self) -> T.StructType:
        """Schema of the wide table: properties in name order, then base columns."""
        fields = [T.StructField(c.column, spark_type(c.type)) for c in self.columns]
        return T.StructType(fields + [T.StructField(n, t) for n, t in BASE_COLUMNS.items()])


def active_schemas(schemas: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """Event types open to validation and migration."""
    active = schemas.where(F.col("db_status") == DB_STATUS["create_pending"])
    return active if names is None else active.where(F.col("name").isin(*names))


def schema_columns(schemas: DataFrame, properties: DataFrame, how: str = "inner") -> DataFrame:
    """One row per event type and column; aliases of a column share one row.

    With ``how="left"``, an event type without columns has a row as well.
    """
    return spelt_columns(schemas, properties, how).drop("spellings")


def spelt_columns(schemas: DataFrame, properties: DataFrame, how: str) -> DataFrame:
    """``schema_columns`` with some registered spellings of each column."""
    kinds = schemas.select(F.col("id").alias("event_id"), identifier("name").alias("schema"))
    spelling = F.col("help_name") if "help_name" in properties.columns else F.lit(None).cast("string")
    declared = properties.select(
        "event_id", "id", "type", identifier("name").alias("property"), spelling.alias("_spelling")
    )
    short = F.when(F.length("_spelling") <= KNOWN_LENGTH, F.col("_spelling"))
    return (
        kinds.join(declared, "event_id", how)
        .groupBy("event_id", "schema", "property")
        .agg(
            F.min_by("type", "id").alias("type"),
            F.slice(F.array_sort(F.collect_set(short)), 1, KNOWN_SPELLINGS).alias("spellings"),
        )
    )


def wide_column(name: str) -> str:
    """Column of a property: its name, with a suffix where it would meet a base column.

    The suffix goes by the name alone and no two names share a column, so a column keeps
    its meaning whatever is registered later.
    """
    return f"{name}_prop" if re.fullmatch(RESERVED, name) else name


def wide_column_of(property: str) -> Column:
    reserved = F.col(property).rlike(rf"^{RESERVED}\z")
    return F.when(reserved, F.concat(property, F.lit("_prop"))).otherwise(F.col(property))


def column_names(properties: Iterable[str]) -> dict[str, str]:
    return {name: wide_column(name) for name in properties}


def type_spellings(
    schemas: DataFrame, max_declared: int = MAX_DECLARED, names: Iterable[str] | None = None
) -> dict[int, list[str]]:
    """Raw names that stand for each registry row: as spelt, where no row has that name.

    A name is resolved as in discovery: by identifier, else as spelt; of several rows the
    one of smallest id counts. With ``names``, only spellings of these rows come to the
    driver, with the rows that may own them instead.
    """
    if "help_name" not in schemas.columns:
        return {}
    rows = schemas.select(
        "id", "name", identifier("name").alias("clean"), "help_name", identifier("help_name").alias("spelt")
    )
    cleans = rows
    if names is not None:
        wanted = rows.where(F.col("name").isin(*names)).select("help_name").distinct()
        rows = rows.join(wanted, "help_name", "left_semi")
        cleans = cleans.join(rows.select(F.col("spelt").alias("clean")).distinct(), "clean", "left_semi")
    found = rows.select("id", "clean", "help_name", "spelt").limit(max_declared + 1).collect()
    if len(found) > max_declared:
        raise ValueError(f"over {max_declared} registered event types; pass names in several runs")
    named = {row["clean"] for row in found}
    if names is not None:
        named = {row["clean"] for row in cleans.select("clean").distinct().collect()}
    owners: dict[str, Row] = {}
    for row in sorted(found, key=itemgetter("id")):
        if row["help_name"] is not None and (row["spelt"] == row["clean"] or row["spelt"] not in named):
            owners.setdefault(row["help_name"], row)
    spellings: dict[int, list[str]] = {}
    for name, row in owners.items():
        spellings.setdefault(row["id"], []).append(name)
    return spellings


def load_event_types(
    schemas: DataFrame,
    properties: DataFrame,
    names: Iterable[str] | None = None,
    max_declared: int = MAX_DECLARED,
) -> list[EventType]:
    """Bring the registry of the active event types to the driver.

    A table's columns must be known before its plan can be written. More than
    ``max_declared`` declared properties are refused: pass ``names`` and handle
    the event types in several runs.
    """
    names = None if names is None else list(names)
    declared = spelt_columns(active_schemas(schemas, names), properties, how="left")
    pairs = f"transform(spellings, s -> struct(s as raw, lower({normal_form('s')}) as clean))"
    declared = declared.withColumn("spellings", F.expr(pairs))
    rows = declared.limit(max_declared + 1).collect()
    if len(rows) > max_declared:
        raise ValueError(f"over {max_declared} declared properties; pass names in several runs")
    rows.sort(key=lambda row: (row["schema"], row["event_id"], row["property"] or ""))
    spelt = type_spellings(schemas, max_declared, names)
    types = []
    for schema, group in groupby(rows, key=itemgetter("schema")):
        # Registry rows whose names have one normal form are one event type.
        group = list(group)
        found: dict[str, WideColumn] = {}
        for row in group:
            name = row["property"]
            if name is not None:
                known = tuple((s["raw"], s["clean"]) for s in row["spellings"])
                found.setdefault(name, WideColumn(name, wide_column(name), row["type"], known))
        wide = tuple(found[name] for name in sorted(found))
        raw = sorted({s for row in group for s in spelt.get(row["event_id"], [])})
        types.append(EventType(group[0]["event_id"], schema, wide, tuple(raw)))
    return sorted(types, key=attrgetter("id"))


def with_event_type(events: DataFrame, types: list[EventType]) -> DataFrame:
    """Keep events of the given types; add ``type_id``, ``schema`` and ``place``.

    ``place`` is the position in ``types``. An event belongs to the type that its name
    stands for as spelt in the registry, else by its identifier. The broadcast sides have
    one row per event type and spelling, all of which came from the driver.
    """
    known = {spelling: kind.name for kind in types for spelling in kind.spellings}
    named = with_identifier(events, "name", "schema", known)
    return named.join(F.broadcast(type_table(events, types)), "schema")


def property_spellings(types: list[EventType]) -> dict[str, str]:
    """Registered spellings of properties with their identifiers."""
    return {raw: clean for kind in types for c in kind.columns for raw, clean in c.spellings}


def type_table(like: DataFrame, types: list[EventType]) -> DataFrame:
    rows = [(place, kind.id, kind.name) for place, kind in enumerate(types)]
    return like.sparkSession.createDataFrame(rows, "place int, type_id long, schema string")


def declared_table(like: DataFrame, types: list[EventType]) -> DataFrame:
    rows = [(k.id, c.property, c.type) for k in types for c in k.columns]
    return like.sparkSession.createDataFrame(rows, "type_id long, property string, type string")
