"""Turn validated events and their properties into typed wide rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propfold.functions.names import identifier
from propfold.functions.values import read_as, refusal
from propfold.operators.clean import recipe
from propfold.operators.fold import MAX_CELL_COLUMNS, cell, fold
from propfold.operators.registry import EventType
from propfold.operators.validate import judge
from propfold.sources.schemas import BASE_COLUMNS, VALID


def ready_events(events: DataFrame, kind: EventType | None = None) -> DataFrame:
    """Events (of one type) that passed validation and are not migrated yet."""
    ready = events.where(~F.col("migrated") & (F.col("valid") == VALID))
    if kind is None:
        return ready
    return ready.where(F.col("name").isin(*kind.spellings) | (identifier("name") == kind.name))


def base_columns() -> list[Column]:
    return [F.col(name).cast(kind).alias(name) for name, kind in BASE_COLUMNS.items()]


def all_cells(types: list[EventType]) -> list[str]:
    return sorted({c.property for kind in types for c in kind.columns})


def misfits(kind: EventType, text) -> Column:
    """Some cell holds text that its declared type does not accept."""
    bad = [text(c.property).isNotNull() & read_as(text(c.property), c.type).isNull() for c in kind.columns]
    return reduce(Column.__or__, bad, F.lit(False))


def wide_rows(rows: DataFrame, kind: EventType, text) -> DataFrame:
    """Base columns and typed properties of the rows whose cells all fit."""
    typed = [read_as(text(c.property), c.type).alias(c.column) for c in kind.columns]
    return rows.where(~misfits(kind, text)).select(*typed, *base_columns())


def joined_cells(events: DataFrame, properties: DataFrame, kind: EventType) -> tuple:
    cells = [c.property for c in kind.columns]
    folded = fold(properties, [kind], cells)
    ready = ready_events(events, kind).select(*BASE_COLUMNS)
    rows = ready.join(folded, ready["id"] == folded["event_id"], "left")
    return rows, lambda name: cell(folded.columns, cells, name)


def pivot_events(events: DataFrame, properties: DataFrame, kind: EventType) -> DataFrame:
    """Wide rows of the ready events of one type; one row per event."""
    rows, text = joined_cells(events, properties, kind)
    return wide_rows(rows, kind, text)


def misfit_cells(events: DataFrame, properties: DataFrame, kind: EventType) -> DataFrame:
    """Cells that keep a ready event out of the wide table."""
    rows, text = joined_cells(events, properties, kind)
    cells = F.array(
        *(
            F.struct(
                F.lit(c.property).alias("property"),
                text(c.property).alias("value"),
                refusal(text(c.property), F.lit(c.type)).alias("reason"),
            )
            for c in kind.columns
        )
    )
    return rows.select(F.col("id").alias("event_id"), F.inline(cells)).where(
        F.col("value").isNotNull() & F.col("reason").isNotNull()
    )


def fold_events(
    events: DataFrame,
    properties: DataFrame,
    types: list[EventType],
    schema_gate: bool | DataFrame = True,
    recipes: bool = False,
    max_cell_columns: int = MAX_CELL_COLUMNS,
    any_size: bool = False,
) -> DataFrame:
    """Pending events of all types, judged, with the raw text of all their cells.

    Verdicts and cells come out of the same aggregation of the property table. With
    ``recipes``, values are judged as their recipe cleans them; with ``any_size``, numbers
    beyond the decimal column are valid (``versions.stored_rows`` keeps them).
    """
    cells = all_cells(types)
    folded = fold(
        properties,
        types,
        cells,
        verdicts=True,
        recipes=recipes,
        max_cell_columns=max_cell_columns,
        any_size=any_size,
    )
    judged = judge(events, folded, types, schema_gate)
    kept = [c for c in folded.columns if c.startswith("cell")]
    return judged.select("schema", "valid", *BASE_COLUMNS, *kept)


def cells_of(folded: DataFrame, types: list[EventType], kind: EventType, recipes: bool):
    """Text of a property in the rows of ``fold_events``, cleaned if ``recipes``."""
    cells, declared = all_cells(types), {c.property: c.type for c in kind.columns}

    def text(name: str) -> Column:
        found = cell(folded.columns, cells, name)
        return recipe(declared[name])(found) if recipes else found

    return text


def pivot_folded(
    folded: DataFrame, types: list[EventType], kind: EventType, recipes: bool = False
) -> DataFrame:
    """Wide rows of one type out of ``fold_events``."""
    rows = folded.where((F.col("schema") == kind.name) & (F.col("valid") == VALID))
    return wide_rows(rows, kind, cells_of(folded, types, kind, recipes))


def typed_rows(folded: DataFrame, types: list[EventType], recipes: bool = False) -> DataFrame:
    """Valid rows of ``fold_events`` of all types: id, schema and typed cells.

    A property has a column for each type that it is declared as, which is filled in the
    rows of the event types that declare it so.
    """
    owners: dict[tuple[str, str], list[EventType]] = {}
    for kind in types:
        for c in kind.columns:
            owners.setdefault((c.property, c.type), []).append(kind)
    typed = [
        F.when(
            F.col("schema").isin(*(kind.name for kind in kinds)),
            read_as(cells_of(folded, types, kinds[0], recipes)(name), declared),
        ).alias(f"{name}_{declared}")
        for (name, declared), kinds in sorted(owners.items())
    ]
    return folded.where(F.col("valid") == VALID).select("id", "schema", *typed)


def cell_text(folded: DataFrame, types: list[EventType]) -> DataFrame:
    """``fold_events`` with one text column per property name."""
    cells = all_cells(types)
    return folded.select(
        "id",
        "schema",
        "valid",
        *(cell(folded.columns, cells, name).alias(f"text_{name}") for name in cells),
    )

