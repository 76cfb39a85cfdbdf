"""Fold the property rows of each event into one row.

This is the only aggregation over the property table. It is keyed by event id
and runs before the join with the events, so it combines on the map side: an
event that holds a large share of all rows leaves each map task as one row, and
what is shuffled and joined is one row per event, not one per property.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence, Sized
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propfold.functions.names import with_identifier
from propfold.functions.numbers import is_number
from propfold.functions.values import NUMERIC, READERS, accepts
from propfold.operators.clean import recipe
from propfold.operators.registry import EventType, property_spellings

# Event types per 64-bit word: one bit "value accepted", one "name registered".
TYPES_PER_WORD = 31

# Event types that are judged by bit words; of more, each event is judged by its own type.
TYPES_PER_FOLD = 8 * TYPES_PER_WORD

# Cells as columns up to this number, as one map beyond.
MAX_CELL_COLUMNS = 64

ANY = "any"


def words_needed(types: Sized) -> int:
    return -(-len(types) // TYPES_PER_WORD)


def by_masks(types: Sized) -> bool:
    """Too many event types for bit words?"""
    return len(types) > TYPES_PER_FOLD


def batches(types: Sequence) -> list[Sequence]:
    """Event types, or lists of spellings, in portions of bounded width."""
    return [types[at : at + TYPES_PER_FOLD] for at in range(0, len(types), TYPES_PER_FOLD)]


def bit_table(like: DataFrame, types: list[EventType]) -> DataFrame:
    """Per property and declared type: the event types that declare it so."""
    bits: dict[str, dict[str, int]] = {}
    for place, kind in enumerate(types):
        word, bit = divmod(place, TYPES_PER_WORD)
        for c in kind.columns:
            declared = c.type if c.type in READERS else ANY
            cell = bits.setdefault(c.property, {})
            for key, shift in ((f"{declared}_{word}", bit), (f"known_{word}", bit + TYPES_PER_WORD)):
                cell[key] = cell.get(key, 0) | 1 << shift
    columns = [
        f"{prefix}_{word}"
        for prefix in (*READERS, ANY, "known")
        for word in range(words_needed(types))
    ]
    rows = [
        (
            name,
            *(any(key.startswith(f"{t}_") for key in cell) for t in READERS),
            *(cell.get(c, 0) for c in columns),
        )
        for name, cell in bits.items()
    ]
    schema = ["_property string"]
    schema += [f"_is_{t} boolean" for t in READERS]
    schema += [f"{c} long" for c in columns]
    return like.sparkSession.createDataFrame(rows, ", ".join(schema))


def word(number: int) -> Column:
    """One property row: for which event types is it known, for which acceptable?"""
    parts = [F.col(f"known_{number}"), F.col(f"{ANY}_{number}")]
    parts += [F.when(F.col(f"_fits_{t}"), F.col(f"{t}_{number}")).otherwise(0) for t in READERS]
    return F.coalesce(reduce(Column.bitwiseOR, parts), F.lit(0).cast("long"))


def fold(
    properties: DataFrame,
    types: list[EventType],
    cells: Iterable[str] = (),
    verdicts: bool = False,
    recipes: bool = False,
    max_cell_columns: int = MAX_CELL_COLUMNS,
    any_size: bool = False,
) -> DataFrame:
    """One row per event id.

    ``cells`` names the properties to keep; each becomes ``cell_<n>`` in the
    given order, holding the value with the highest property id. Beyond
    ``max_cell_columns`` they become entries of the map ``cells``.

    With ``verdicts``, ``word_<n>`` holds for each event type whether all the
    properties of the event are registered and acceptable (``fold_masks`` beyond
    ``TYPES_PER_FOLD`` event types); with ``recipes``, after the
    cleaning of each value by the recipe of the type it is declared as. With ``any_size``,
    numbers are acceptable that the decimal column cannot hold.
    """
    cells = list(cells)
    if verdicts and by_masks(types):
        return fold_masks(properties, types, cells, recipes, any_size)
    named = with_identifier(properties, "name", "_property", property_spellings(types))
    words = range(words_needed(types)) if verdicts else range(0)
    if verdicts:
        # Broadcast: one row per declared property, all from the driver.
        named = named.join(F.broadcast(bit_table(properties, types)), "_property", "left")
        named = with_checks(named, recipes, any_size)
        named = named.withColumns({f"word_{n}": word(n) for n in words})
    else:
        named = named.where(F.col("_property").isin(cells))
    verdict_words = [F.bit_and(f"word_{n}").alias(f"word_{n}") for n in words]
    if len(cells) <= max_cell_columns:
        # The highest (id, value) holds the latest value, be it NULL.
        named = named.withColumn("_entry", F.struct("id", "value"))
        latest = [
            F.max(F.when(F.col("_property") == name, F.col("_entry")))["value"].alias(f"cell_{n}")
            for n, name in enumerate(cells)
        ]
        if not (verdict_words or latest):
            return named.select("event_id").distinct()
        return named.groupBy("event_id").agg(*verdict_words, *latest)
    # A map holds no more entries than there are declared properties.
    entry = F.when(F.col("_property").isin(cells), F.struct("_property", "value"))
    return (
        named.groupBy("event_id", "_property")
        .agg(*verdict_words, F.max(F.struct("id", "value"))["value"].alias("value"))
        .groupBy("event_id")
        .agg(*verdict_words, F.map_from_entries(F.collect_list(entry)).alias("cells"))
    )


def with_checks(named: DataFrame, recipes: bool, any_size: bool) -> DataFrame:
    """Rows with ``_fits_<type>``; a check runs only where some event type declares the property so."""
    values = {t: recipe(t)(F.col("value")) if recipes else F.col("value") for t in READERS}
    fits = {t: accepts(values[t], t) for t in READERS}
    if any_size:
        fits[NUMERIC] = F.coalesce(is_number(values[NUMERIC]), F.lit(False))
    return named.withColumns({f"_fits_{t}": F.when(F.col(f"_is_{t}"), fits[t]) for t in READERS})


# One bit per declared type, and one for types that accept anything.
MASK = {t: 1 << place for place, t in enumerate((*READERS, ANY))}


def fold_masks(
    properties: DataFrame, types: list[EventType], cells: list[str], recipes: bool, any_size: bool
) -> DataFrame:
    """One row per event id, for any number of event types in one pass.

    ``masks`` says of each registered property of the event which declared types accept all
    its values, ``unknown`` whether the event has a property that no type declares, and
    ``cells`` holds the texts. Rows are combined by event and property first, so what is
    gathered for an event is one entry for each registered property at most.
    """
    named = with_identifier(properties, "name", "_property", property_spellings(types))
    declared = declared_types(types)
    rows = [(name, *(t in kinds for t in READERS)) for name, kinds in declared.items()]
    schema = ", ".join(["_property string", *(f"_is_{t} boolean" for t in READERS)])
    # Broadcast: one row per declared property, all from the driver.
    listed = F.broadcast(properties.sparkSession.createDataFrame(rows, schema))
    named = with_checks(named.join(listed, "_property", "left"), recipes, any_size)
    known = F.col(f"_is_{NUMERIC}").isNotNull()
    mask = F.lit(MASK[ANY])
    for t in READERS:
        mask = mask + F.when(F.col(f"_fits_{t}"), MASK[t]).otherwise(0)
    latest = F.max(F.when(F.col("_property").isin(cells), F.struct("id", "value"))).alias("_latest")
    one = (
        named.withColumns({"_property": F.when(known, F.col("_property")), "_mask": mask})
        .groupBy("event_id", "_property")
        .agg(F.bit_and("_mask").alias("_mask"), *([latest] if cells else []))
    )
    judged = F.when(F.col("_property").isNotNull(), F.struct("_property", "_mask"))
    verdicts = [
        F.bool_or(F.col("_property").isNull()).alias("unknown"),
        F.map_from_entries(F.collect_list(judged)).alias("masks"),
    ]
    if not cells:
        return one.groupBy("event_id").agg(*verdicts)
    text = F.when(F.col("_latest").isNotNull(), F.struct("_property", F.col("_latest")["value"].alias("value")))
    return one.groupBy("event_id").agg(*verdicts, F.map_from_entries(F.collect_list(text)).alias("cells"))


def declared_types(types: list[EventType]) -> dict[str, set[str]]:
    """As what is each property declared by the event types?"""
    found: dict[str, set[str]] = {}
    for kind in types:
        for c in kind.columns:
            found.setdefault(c.property, set()).add(c.type if c.type in READERS else ANY)
    return found


def with_declared(typed: DataFrame, types: list[EventType]) -> DataFrame:
    """Events with what their type declares, where the fold says what fits by masks."""
    if not by_masks(types):
        return typed
    rows = [
        (place, {c.property: MASK.get(c.type, MASK[ANY]) for c in kind.columns})
        for place, kind in enumerate(types)
    ]
    table = typed.sparkSession.createDataFrame(rows, "place int, declared map<string,int>")
    # Broadcast: one entry per row of the registry, all from the driver.
    return typed.join(F.broadcast(table), "place")


def all_masks(fits: Callable[[Column, Column], Column]) -> Column:
    """Is the test true of the mask and the declared bit of every property of the event?"""
    each = F.map_entries("masks")
    test = F.forall(each, lambda e: F.coalesce(fits(e["value"], F.try_element_at("declared", e["key"])), F.lit(False)))
    return ~F.col("unknown") & test


def cell(folded_columns: Iterable[str], cells: list[str], name: str) -> Column:
    """The text of property ``name`` in a row made by ``fold``."""
    if "cells" in folded_columns:
        return F.try_element_at("cells", F.lit(name))
    return F.col(f"cell_{cells.index(name)}")


def bit_at_place(words: int, shift: int = 0) -> Column:
    """The bit of the event type at ``place``, as a boolean."""
    found = F.lit(None).cast("long")
    for n in range(words):
        here = F.floor(F.col("place") / TYPES_PER_WORD) == n
        found = F.when(here, F.col(f"word_{n}")).otherwise(found)
    return F.getbit(found, F.col("place") % TYPES_PER_WORD + shift) == 1


def accepted(types: list[EventType]) -> Column:
    if by_masks(types):
        return all_masks(lambda mask, bit: mask.bitwiseAND(bit) != 0)
    return bit_at_place(words_needed(types))


def registered(types: list[EventType]) -> Column:
    if by_masks(types):
        return all_masks(lambda mask, bit: bit.isNotNull())
    return bit_at_place(words_needed(types), TYPES_PER_WORD)


def fold_known(properties: DataFrame, spellings: list[list[str]]) -> DataFrame:
    """One row per event id: in which lists are all its property spellings?

    List number ``place`` has its bit where ``known_at_place`` finds it.
    """
    words = range(words_needed(spellings))
    bits: dict[str, list[int]] = {}
    for place, listed in enumerate(spellings):
        number, bit = divmod(place, TYPES_PER_WORD)
        for spelling in listed:
            bits.setdefault(spelling, [0] * len(words))[number] |= 1 << bit
    schema = ", ".join(["name string", *(f"_word_{n} long" for n in words)])
    rows = [(spelling, *numbers) for spelling, numbers in bits.items()]
    # Broadcast: one row per spelling, all from the driver.
    table = F.broadcast(properties.sparkSession.createDataFrame(rows, schema))
    named = properties.where(F.col("name").isNotNull()).join(table, "name", "left")
    return named.groupBy("event_id").agg(
        F.count("*").alias("n_properties"),
        *(F.bit_and(F.coalesce(f"_word_{n}", F.lit(0))).alias(f"word_{n}") for n in words),
    )


def known_at_place(lists: int) -> Column:
    return F.coalesce(bit_at_place(-(-lists // TYPES_PER_WORD)), F.lit(False))
