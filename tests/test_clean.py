from propfold.operators import clean as c
from propfold.operators.registry import EventType, WideColumn
from propfold.operators.scans import ids_of_events, ids_of_incomplete_users

ROWS = [
    (1, "VALOR TOTAL", " 1 2,5 ", 1),
    (2, "VALOR_TOTAL", "$1,5 €", 1),
    (3, "K", " 3 ", 1),
    (4, "VALOR TOTAL", " 4 ", 2),
    (5, None, " 5 ", 1),
    (6, "VALOR TOTAL", None, 1),
    (7, "VALOR TOTAL", " 7 ", 99),
]


def tables(spark):
    props = spark.createDataFrame(ROWS, "id long, name string, value string, event_id long")
    events = spark.createDataFrame([(1, "A", False), (2, "B", False)], "id long, name string, migrated boolean")
    return events, props


def values(rows):
    return {r["id"]: r["value"] for r in rows.collect()}


def test_only_rows_in_scope_change(spark):
    events, props = tables(spark)
    before = {r[0]: r[2] for r in ROWS}
    found = c.clean_values(props, ids_of_events(events, "A"), "VALOR_TOTAL", c.remove_space)
    assert found.columns == props.columns
    assert values(found) == {**before, 1: "12,5", 2: "$1,5€"}
    found = c.clean_values(props, ids_of_events(events, "A"), "K", c.blank)
    assert values(found) == {**before, 3: None}
    found = c.clean_values(props, ids_of_events(events, "nothing"), "%", c.blank)
    assert values(found) == before


def test_rename(spark):
    events, props = tables(spark)
    found = c.rename_property(props, ids_of_events(events, "A"), "VALOR%", "valor").collect()
    assert {r["id"]: r["name"] for r in found} == {
        1: "valor", 2: "valor", 3: "K", 4: "VALOR TOTAL", 5: None, 6: "valor", 7: "VALOR TOTAL"
    }


def test_recipe_of_declared_type(spark):
    events, props = tables(spark)
    kind = EventType(1, "a", (WideColumn("valor_total", "valor_total", "numeric"), WideColumn("k", "k", "date")))
    found = values(c.clean_declared_values(events, props, [kind]))
    assert found == {1: "12.5", 2: "1.5", 3: "3", 4: " 4 ", 5: " 5 ", 6: None, 7: " 7 "}


def test_swap_text(spark):
    events, props = tables(spark)
    found = values(c.clean_values(props, ids_of_events(events, "A"), "VALOR%", c.swap_text(",5", "", "first")))
    assert found[1] == " 1 2 " and found[2] == "$1 €"


def test_scope_of_users(spark):
    users = spark.createDataFrame(
        [(1, "e", "m", "i"), (2, None, "m", "i"), (3, "e", None, "i"), (4, "e", "m", None)],
        "id long, email string, mobile_number string, identification string",
    )
    assert {r[0] for r in ids_of_incomplete_users(users).collect()} == {2, 3, 4}


def test_email_validity(spark):
    rows = spark.createDataFrame([("a@b.c",), ("a@b.c",), ("no",), (None,)], "value string")
    assert {tuple(r) for r in c.email_validity(rows).collect()} == {("a@b.c", True), ("no", False)}
