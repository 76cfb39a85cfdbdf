"""Wide rows of many event types in one table, and of one type over all its versions.

A property is stored under its name and its declared type, so a type that is declared anew
adds a column and no file has to be read as something it is not. The rows of all event
types are one relation, written by one job. A reader gives the stored columns that a type
has ever had, and sees each property as it is declared now: what was written under
another type is converted, and is NULL where it does not fit.

Numbers that the decimal column rounds (over 18 decimals) or cannot hold (over 20 digits
before the point) keep their exact text in one map column of the row, which is NULL in
nearly all rows. ``number_text`` and ``numbers.order_key`` read and sort them exactly.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propfold.functions import numbers
from propfold.functions.names import column
from propfold.functions.values import DATE, INTEGER, NUMERIC, READERS, VARCHAR, read_as, spark_type
from propfold.operators.pivot import base_columns, cells_of
from propfold.operators.registry import EventType, WideColumn
from propfold.sources.schemas import BASE_COLUMNS, VALID

# How the partition of an event type is named; the name itself may be empty.
TYPE_PREFIX = "type:"

# Column of exact texts by property; stored properties have ``__`` in their names.
EXACT = "exact_numbers"
EXACT_TYPE = T.MapType(T.StringType(), T.StringType())


def declared_type(declared: str) -> str:
    return declared if declared in READERS else VARCHAR


def stored_column(name: str, declared: str) -> str:
    """Column that holds a property while it is declared as a type; types have no ``__``."""
    return f"{name}__{declared_type(declared)}"


def stored_rows(folded: DataFrame, types: list[EventType], recipes: bool = False) -> DataFrame:
    """Valid rows of ``fold_events`` of all types: base columns, stored columns, ``event_type``."""
    owners: dict[tuple[str, str], list[EventType]] = {}
    for kind in types:
        for c in kind.columns:
            owners.setdefault((c.property, declared_type(c.type)), []).append(kind)
    typed, lost = [], {}
    for (name, declared), kinds in sorted(owners.items()):
        here = F.col("schema").isin(*(kind.name for kind in kinds))
        text = cells_of(folded, types, kinds[0], recipes)(name)
        typed.append(F.when(here, read_as(text, declared)).alias(stored_column(name, declared)))
        if declared == NUMERIC:
            lost[name] = F.when(here, numbers.lost_text(text))
    return folded.where(F.col("valid") == VALID).select(
        *base_columns(), *typed, texts_map(lost).alias(EXACT), F.concat(F.lit(TYPE_PREFIX), "schema").alias("event_type")
    )


def texts_map(texts: dict[str, Column]) -> Column:
    """The texts that are not NULL, by name; NULL if there are none."""
    if not texts:
        return F.lit(None).cast(EXACT_TYPE)
    entries = F.array(*(F.struct(F.lit(name).alias("key"), text.alias("value")) for name, text in texts.items()))
    some = F.coalesce(*texts.values()).isNotNull()
    return F.when(some, F.map_from_entries(F.filter(entries, lambda entry: entry["value"].isNotNull())))


def stored_struct(kind: EventType, history: dict[str, set[str]]) -> T.StructType:
    """Stored columns that a type has ever had, by property; base columns first."""
    fields = [T.StructField(name, of) for name, of in BASE_COLUMNS.items()]
    for c in kind.columns:
        for declared in sorted(history.get(c.property, set()) | {declared_type(c.type)}):
            fields.append(T.StructField(stored_column(c.property, declared), spark_type(declared)))
    return T.StructType([*fields, T.StructField(EXACT, EXACT_TYPE)])


def as_text(value: Column, declared: str) -> Column:
    """A typed value as it would be written; numbers without trailing zeros."""
    if declared == NUMERIC:
        digits = F.regexp_replace(value.cast("string"), r"0+\z", "")
        return F.when(value == 0, "0").otherwise(F.regexp_replace(digits, r"[.]\z", ""))
    return value.cast("string")


def converted(value: Column, old: str, new: str) -> Column:
    """A value stored as one type, read as another; NULL where it does not fit."""
    if old == INTEGER and new == NUMERIC:
        return value.cast(spark_type(NUMERIC))
    if old == DATE and new != VARCHAR or new == DATE and old != VARCHAR:
        return F.lit(None).cast(spark_type(new))
    if old == NUMERIC and new == INTEGER:
        return F.when(value == F.round(value), value.try_cast("int"))
    return read_as(as_text(value, old), new)


def number_text(number: Column, lost: Column) -> Column:
    """Text of a stored number: the exact one where the column has lost it."""
    return F.coalesce(lost, as_text(number, NUMERIC))


def read_column(c: WideColumn, types: Iterable[str]) -> Column:
    """A property as it is declared now, out of the stored columns of all its types."""
    now = declared_type(c.type)
    own = column(stored_column(c.property, now))
    others = [version(c.property, t, now) for t in sorted(set(types) - {now})]
    return F.coalesce(own, *others).alias(c.column)


def version(name: str, old: str, new: str) -> Column:
    """A property in the column of an earlier type, read as a later one."""
    stored = column(stored_column(name, old))
    if old != NUMERIC:
        return converted(stored, old, new)
    lost = F.try_element_at(EXACT, F.lit(name))
    if new == VARCHAR:
        return number_text(stored, lost)
    # What the column has lost is no integer that another column could hold.
    return F.when(lost.isNull(), converted(stored, old, new))


def read_exact(c: WideColumn, types: Iterable[str]) -> Column:
    """Exact text of a property declared as a number now, where its column has lost it."""
    found = F.try_element_at(EXACT, F.lit(c.property))
    if VARCHAR in types:
        found = F.coalesce(found, numbers.lost_text(column(stored_column(c.property, VARCHAR))))
    return found


def read_rows(
    stored: DataFrame, kind: EventType, history: dict[str, set[str]], exact: bool = False
) -> DataFrame:
    """Rows of a type in the columns of its wide table.

    With ``exact``, the map ``exact_numbers`` follows: by column, the exact texts of the
    numbers that the column rounds or leaves out; NULL where it loses none.
    """
    typed = [read_column(c, history.get(c.property, ())) for c in kind.columns]
    if not exact:
        return stored.select(*typed, *base_columns())
    lost = {c.column: read_exact(c, history.get(c.property, ())) for c in kind.columns if c.type == NUMERIC}
    return stored.select(*typed, *base_columns(), texts_map(lost).alias(EXACT))
