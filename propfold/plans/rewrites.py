"""Cleaning jobs over a property table in parts: only what a pattern touches is rewritten."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propfold.operators import clean
from propfold.operators.scans import ids_of_events, ids_of_incomplete_users
from propfold.sources.parts import NamedParts, part_of
from propfold.sources.tables import TenantTables


def split_job(tables: TenantTables, table: str, run_id: int) -> NamedParts:
    """Put a property table into parts."""
    parts = NamedParts(tables, table)
    if not parts.has_run(run_id):
        parts.write(run_id, tables.read(table))
    return parts


def owners_in_scope(parts: NamedParts, event: str | None) -> DataFrame:
    """Owners whose values may be changed: events of a name, or incomplete users."""
    if parts.table == "event_property":
        return ids_of_events(parts.tables.read("user_event"), event)
    return ids_of_incomplete_users(parts.tables.read("user_company"))


def clean_job(
    parts: NamedParts, pattern: str, change: clean.Change, run_id: int, event: str | None = None
) -> list[int]:
    """Change the values of names like the pattern; returns the parts rewritten.

    The pattern is resolved to parts by the manifest, so rows of other parts are not read.
    """
    if parts.has_run(run_id):
        return []
    touched = parts.parts_like(pattern)
    if touched:
        rows = clean.clean_values(parts.read(touched), owners_in_scope(parts, event), pattern, change)
        parts.write(run_id, rows, touched)
    return touched


def rename_job(
    parts: NamedParts, pattern: str, new_name: str, run_id: int, event: str | None = None
) -> list[int]:
    """Rename properties like the pattern; their new part is rewritten as well."""
    if parts.has_run(run_id):
        return []
    touched = parts.parts_like(pattern)
    if touched:
        target = parts.spark.range(1).select(part_of(F.lit(new_name))).first()[0]
        touched = sorted({*touched, target})
        rows = clean.rename_property(parts.read(touched), owners_in_scope(parts, event), pattern, new_name)
        parts.write(run_id, rows, touched)
    return touched
