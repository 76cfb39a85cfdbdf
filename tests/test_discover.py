from datetime import datetime

import pytest

from propfold.operators import discover as d
from propfold.operators.registry import load_event_types
from propfold.operators.sizing import only_of
from propfold.sources.schemas import table_schema

NOW = datetime(2024, 5, 1, 12, 30)


def registry(spark, rows):
    full = [(i, name, raw, None, 2, 1, NOW, NOW, True, False) for i, name, raw in rows]
    return spark.createDataFrame(full, table_schema("event_schema"))


def declared(spark, rows):
    full = [(i, name, event, raw, kind, 2, 1, NOW, NOW, True) for i, name, event, raw, kind in rows]
    return spark.createDataFrame(full, table_schema("property_event_schema"))


def events(spark, rows):
    return spark.createDataFrame(rows, "id long, name string")


def properties(spark, rows):
    return spark.createDataFrame(rows, "id long, name string, event_id long")


def test_new_event_names(spark):
    known = registry(spark, [(40, "purchase", "PURCHASE"), (7, "old", "Raw Name")])
    seen = events(
        spark,
        [(1, "PURCHASE"), (2, "Purchase"), (3, "Raw Name"), (4, "Sign Up"), (5, "SIGN_UP"), (9, "Año"), (10, None)],
    )
    new = d.discover_event_schemas(seen, known, NOW)
    rows = {r["name"]: r for r in new.collect()}
    assert set(rows) == {"sign_up", "ano"}
    assert rows["sign_up"]["help_name"] == "SIGN_UP"
    assert rows["sign_up"]["id"] == 41 + 4 and rows["ano"]["id"] == 41 + 9
    assert rows["ano"]["db_status"] == 2 and rows["ano"]["migrate_status"] == 1
    assert rows["ano"]["is_active"] and not rows["ano"]["is_migrated"]
    assert rows["ano"]["created_at"] == NOW
    grown = d.registered_with(known, new)
    assert grown.count() == 4
    assert d.discover_event_schemas(seen, grown, NOW).count() == 0


def test_first_registry_starts_at_zero(spark):
    new = d.discover_event_schemas(events(spark, [(0, "a"), (1, "b")]), registry(spark, []), NOW)
    assert {r["name"]: r["id"] for r in new.collect()} == {"a": 0, "b": 1}


def test_new_properties_and_aliases(spark):
    known = registry(spark, [(1, "purchase", "PURCHASE"), (2, "old", "Raw Name")])
    names = declared(spark, [(10, "valor_total", 1, "VALOR TOTAL", "numeric")])
    seen = events(spark, [(1, "PURCHASE"), (2, "purchase"), (3, "Raw Name"), (4, "unknown")])
    props = properties(
        spark,
        [(1, "VALOR TOTAL", 1), (2, "Valor Total", 1), (3, "K", 2), (4, "k", 1), (5, "K", 3), (6, "z", 4), (7, None, 1)],
    )
    new = d.discover_properties(seen, props, known, names, NOW)
    found = {(r["event_id"], r["help_name"]): (r["name"], r["is_alias"], r["id"]) for r in new.collect()}
    assert found == {
        (1, "Valor Total"): ("valor_total", True, 13),
        (1, "K"): ("k", False, 14),
        (1, "k"): ("k", True, 15),
        (2, "K"): ("k", False, 16),
    }
    grown = d.registered_with(names, new)
    assert d.discover_properties(seen, props, known, grown, NOW).count() == 0
    types = {t.name: [(c.column, c.type) for c in t.columns] for t in load_event_types(known, grown)}
    assert types == {"purchase": [("k", "varchar"), ("valor_total", "numeric")], "old": [("k", "varchar")]}


def test_only_events_with_news_are_looked_at(spark, monkeypatch):
    known = registry(spark, [(1, "purchase", "PURCHASE"), (2, "old", "Raw Name"), (3, "empty", "empty")])
    names = declared(
        spark,
        [(10, "k", 1, "K", "numeric"), (11, "k", 2, "k", "numeric"), (12, "k", 1, "k", "numeric"), (13, "wrong", 2, "Z", "date")],
    )
    seen = events(spark, [(1, "PURCHASE"), (2, "purchase"), (3, "Raw Name"), (4, "unknown"), (5, "old"), (6, "Empty"), (7, "PURCHASE"), (8, None)])
    props = properties(
        spark,
        [(1, "K", 1), (2, "k", 1), (3, "K", 2), (4, "new", 2), (5, "k", 3), (6, "z", 4), (7, "Z", 5), (8, "K", 6), (9, None, 7), (10, "k", 8)],
    )
    ids = d.events_with_new_properties(seen, props, known, names)
    assert sorted(r[0] for r in ids.collect()) == [2, 5, 6]
    monkeypatch.setattr(d, "MAX_DECLARED", 1)
    joined = d.events_with_new_properties(seen, props, known, names)
    assert sorted(r[0] for r in joined.collect()) == [2, 5, 6]
    whole = d.discover_properties(seen, props, known, names, NOW)
    part = d.discover_properties(
        only_of(seen, "id", ids), only_of(props, "event_id", ids, max_rows=1), known, names, NOW
    )
    assert sorted(map(str, part.collect())) == sorted(map(str, whole.collect()))


def test_first_discovery_looks_at_all(spark):
    known = registry(spark, [(1, "purchase", "PURCHASE")])
    seen = events(spark, [(1, "PURCHASE"), (2, "PURCHASE")])
    props = properties(spark, [(1, "K", 1), (2, "k", 2)])
    ids = d.events_with_new_properties(seen, props, known, declared(spark, []))
    assert sorted(r[0] for r in ids.collect()) == [1, 2]


def test_ids_stay_small_where_facts_have_large_ones(spark):
    big = 5 * 10**18
    known = registry(spark, [(big, "a", "a")])
    new = d.discover_event_schemas(events(spark, [(big + 16 * k, f"n{k}") for k in range(20)]), known, NOW)
    ids = {r["id"] for r in new.collect()}
    assert len(ids) == 20 and big < min(ids) and max(ids) <= big + 16 * 21


def test_names_are_loaded_out_of_a_large_registry(spark):
    """The bound on registered types counts what is asked for, not what there is."""
    rows = [(k, f"type_{k}", f"Type {k}", 2) for k in range(60)] + [(100, "wanted", "Wanted!", 2), (101, "wanted!", "x", 2)]
    schemas = spark.createDataFrame(rows, "id long, name string, help_name string, db_status int")
    declared = spark.createDataFrame([(1, "a", 100, "a", "varchar")], "id long, name string, event_id long, help_name string, type string")
    with pytest.raises(ValueError, match="over 50"):
        load_event_types(schemas, declared, max_declared=50)
    (kind,) = load_event_types(schemas, declared, ["wanted"], max_declared=50)
    every = {k.name: k for k in load_event_types(schemas, declared)}
    assert kind == every["wanted"] and kind.spellings == every["wanted"].spellings
    (kind,) = load_event_types(schemas, declared, ["type_7"], max_declared=50)
    assert kind.spellings == every["type_7"].spellings
