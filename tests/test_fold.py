"""Validation and pivot against brute force, with hot events and many types."""

import random
from collections import defaultdict

import pytest
from test_names import by_hand
from test_values import python_accepts

from propfold.operators import fold
from propfold.operators.pivot import fold_events, misfit_cells, pivot_events, pivot_folded
from propfold.operators.registry import EventType, WideColumn
from propfold.operators.validate import (
    refused_properties,
    schema_conformance,
    validate_events,
    with_verdicts,
)
from propfold.sources.schemas import table_schema

SPELLINGS = {"valor_total": ["VALOR TOTAL", "Valor Total", "valor_total"], "k": ["K", "k"], "fecha": ["FECHA"], "ano": ["Año", "A|no"]}
VALUES = ["12", "12,5", " 7 ", "abc", "2024-02-28", "2024-02-30", None, "", "x" * 300]


def kinds(count: int) -> list[EventType]:
    pick = random.Random(count)
    types = []
    for i in range(count):
        names = sorted(pick.sample(sorted(SPELLINGS), pick.randint(1, 4)))
        columns = [WideColumn(c, c, pick.choice(["varchar", "integer", "numeric", "date", "json"])) for c in names]
        types.append(EventType(i, f"type_{i}", tuple(columns)))
    return types


def tables(spark, types, seed=3, events=400, hot=True):
    pick = random.Random(seed)
    event_rows, property_rows = [], []
    for i in range(events):
        name = pick.choice(types).name.replace("_", " ").upper()
        event_rows.append((i, name, pick.choice([False, False, False, True, None])))
        kind = next(k for k in types if k.name == by_hand(name).lower())
        known = [c.property for c in kind.columns]
        for _ in range(pick.randint(0, 4)):
            prop = pick.choice(known) if pick.random() < 0.9 else pick.choice(sorted(SPELLINGS))
            property_rows.append((pick.choice(SPELLINGS[prop]), pick.choice(VALUES), i))
    if hot:
        # One event holds a third of all property rows.
        known = types[0].columns[0].property
        event_rows.append((events, types[0].name, False))
        property_rows += [(SPELLINGS[known][0], "12", events)] * (len(property_rows) // 2)
    pick.shuffle(property_rows)
    property_rows = [(i, *row) for i, row in enumerate(property_rows)]
    e = spark.createDataFrame(event_rows, "id long, name string, migrated boolean")
    full = e.selectExpr(
        "id", "name", "string(null) as value", "string(null) as email", "string(null) as valid",
        "migrated", "id as user_id", "timestamp_ntz'2024-01-01 10:00:00' as created_at",
        "timestamp_ntz'2024-01-02 10:00:00' as updated_at", "id as integration_id",
        "'sdk' as integration_type", "'u' as uuid",
    )
    assert full.columns == table_schema("user_event").names
    p = spark.createDataFrame(property_rows, "id long, name string, value string, event_id long").repartition(6)
    return full, p, event_rows, property_rows


def accepts(value, declared):
    if declared == "json":
        return True
    if declared == "varchar":
        return True
    return value is not None and python_accepts(value, declared)


def expected(types, event_rows, property_rows):
    by_name = {k.name: k for k in types}
    by_event = defaultdict(list)
    for pid, name, value, event_id in property_rows:
        by_event[event_id].append((pid, by_hand(name).lower(), value))
    verdicts, conforms, cells = {}, defaultdict(lambda: True), {}
    for event_id, name, migrated in event_rows:
        kind = by_name[by_hand(name).lower()]
        declared = {c.property: c.type for c in kind.columns}
        rows = by_event[event_id]
        for _, prop, _ in rows:
            conforms[kind.name] = conforms[kind.name] and prop in declared
        if migrated is False:
            fine = all(prop in declared and accepts(value, declared[prop]) for _, prop, value in rows)
            verdicts[event_id] = (kind.name, "validated" if fine else "unvalid")
            cells[event_id] = {prop: value for _, prop, value in sorted(rows)}
    return verdicts, dict(conforms), cells


@pytest.mark.parametrize("count, per_fold", [(3, 248), (32, 248), (70, 248), (70, 33)])
def test_verdicts(spark, monkeypatch, count, per_fold):
    monkeypatch.setattr(fold, "TYPES_PER_FOLD", per_fold)
    types = kinds(count)
    events, properties, event_rows, property_rows = tables(spark, types)
    verdicts, conforms, _ = expected(types, event_rows, property_rows)
    assert fold.words_needed(types) == (count + 30) // 31
    found = validate_events(events, properties, types, schema_gate=False).collect()
    assert len(found) == len(verdicts)
    assert {r["id"]: (r["schema"], r["valid"]) for r in found} == verdicts
    gate = {r["schema"]: r["conforms"] for r in schema_conformance(events, properties, types).collect()}
    assert gate == conforms
    gated = validate_events(events, properties, types).collect()
    assert {r["id"] for r in gated} == {i for i, (name, _) in verdicts.items() if conforms.get(name)}


def test_refusals_explain_the_verdicts(spark):
    types = kinds(5)
    events, properties, event_rows, property_rows = tables(spark, types)
    verdicts, _, _ = expected(types, event_rows, property_rows)
    refused = refused_properties(events, properties, types).collect()
    assert {r["event_id"] for r in refused} == {i for i, (_, ok) in verdicts.items() if ok == "unvalid"}


@pytest.mark.parametrize("most, per_fold", [(64, 248), (1, 248), (64, 2)])
def test_pivot_of_all_types(spark, monkeypatch, most, per_fold):
    monkeypatch.setattr(fold, "TYPES_PER_FOLD", per_fold)
    types = kinds(4)
    events, properties, event_rows, property_rows = tables(spark, types)
    verdicts, _, cells = expected(types, event_rows, property_rows)
    folded = fold_events(events, properties, types, schema_gate=False, max_cell_columns=most)
    for kind in types:
        rows = pivot_folded(folded, types, kind).collect()
        assert {r["id"] for r in rows} == {
            i for i, (name, ok) in verdicts.items() if name == kind.name and ok == "validated"
        }
        assert len(rows) == len({r["id"] for r in rows})
        for r in rows:
            for c in kind.columns:
                text = cells[r["id"]].get(c.property)
                value = r[c.column]
                if text is None:
                    assert value is None
                elif c.type == "integer":
                    assert value == int(text)
                elif c.type == "numeric":
                    assert float(value) == float(text.replace(",", "."))
                elif c.type == "date":
                    assert value.isoformat() == text
                else:
                    assert value == text


def test_pivot_of_flagged_events_equals_the_fused_one(spark):
    types = kinds(3)
    events, properties, _, _ = tables(spark, types, seed=5)
    judged = with_verdicts(events, validate_events(events, properties, types, schema_gate=False))
    folded = fold_events(events, properties, types, schema_gate=False)
    for kind in types:
        one = pivot_events(judged, properties, kind)
        assert sorted(map(str, one.collect())) == sorted(
            map(str, pivot_folded(folded, types, kind).collect())
        )


def test_misfits_stay_out(spark):
    kind = EventType(1, "purchase", (WideColumn("k", "k", "integer"), WideColumn("fecha", "fecha", "date")))
    events, _, _, _ = tables(spark, [kind], events=3, hot=False)
    events = events.selectExpr("* except (valid, migrated)", "'validated' as valid", "false as migrated")
    properties = spark.createDataFrame(
        [(1, "k", "5", 0), (2, "k", "x", 1), (3, "fecha", "2024-01-01", 1)],
        "id long, name string, value string, event_id long",
    )
    assert {r["id"]: r["k"] for r in pivot_events(events, properties, kind).collect()} == {0: 5, 2: None}
    bad = misfit_cells(events, properties, kind).collect()
    assert [tuple(r) for r in bad] == [(1, "k", "x", "not_integer")]


def test_property_without_a_name_is_unregistered(spark):
    kind = EventType(1, "purchase", (WideColumn("k", "k", "varchar"),))
    events, _, _, _ = tables(spark, [kind], events=2, hot=False)
    events = events.selectExpr("* except (migrated)", "false as migrated")
    properties = spark.createDataFrame(
        [(1, "k", "5", 0), (2, None, "x", 1), (3, "k", "y", None)],
        "id long, name string, value string, event_id long",
    )
    found = validate_events(events, properties, [kind], schema_gate=False)
    assert {r["id"]: r["valid"] for r in found.collect()} == {0: "validated", 1: "unvalid"}
    (refused,) = refused_properties(events, properties, [kind]).collect()
    assert (refused["event_id"], refused["name"], refused["reason"]) == (1, None, "unregistered")
    assert not schema_conformance(events, properties, [kind]).first()["conforms"]


def test_no_event_types(spark):
    events, properties, _, _ = tables(spark, kinds(2), events=5, hot=False)
    assert validate_events(events, properties, [], schema_gate=False).count() == 0
    assert validate_events(events, properties, []).count() == 0
    assert schema_conformance(events, properties, []).count() == 0


def test_event_type_without_columns(spark):
    kind = EventType(1, "purchase", ())
    events, properties, _, _ = tables(spark, [EventType(1, "purchase", (WideColumn("k", "k", "varchar"),))], events=30, hot=False)
    found = validate_events(events, properties, [kind], schema_gate=False)
    with_any = {r["event_id"] for r in properties.select("event_id").distinct().collect()}
    assert {r["id"]: r["valid"] for r in found.collect()} == {
        r["id"]: "unvalid" if r["id"] in with_any else "validated"
        for r in events.where("not migrated").collect()
    }
    folded = fold_events(events, properties, [kind], schema_gate=False)
    rows = pivot_folded(folded, [kind], kind)
    assert rows.columns == kind.struct().names
    assert rows.count() == found.where("valid = 'validated'").count()
