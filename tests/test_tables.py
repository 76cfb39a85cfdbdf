from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from propfold.operators import registry as r
from propfold.operators.discover import with_schema_id
from propfold.operators.sizing import attach, fits_broadcast
from propfold.operators.wide_table import append_to_table, build_table, wide_table_schema
from propfold.session import shared_dir
from propfold.sources import tables as t
from propfold.sources.schemas import BASE_COLUMNS, DB_STATUS, TABLES, status_code, table_schema


def kind(*columns):
    names = r.column_names(c for c, _ in columns)
    return r.EventType(1, "purchase", tuple(r.WideColumn(c, names[c], k) for c, k in columns))


def test_create_evolve_append(spark):
    table = "wide_purchase"
    small = kind(("k", "integer"), ("valor_total", "numeric"))
    assert build_table(spark, table, small) == ["k", "valor_total", *BASE_COLUMNS]
    assert spark.table(table).schema == small.struct()
    row = (1, Decimal("2.5"), 10, date(2024, 1, 2), date(2024, 1, 1), 7, 8, "sdk", "u")
    batch = spark.createDataFrame([row], small.struct())
    append_to_table(batch, table)
    append_to_table(batch, table)
    assert spark.table(table).count() == 1
    wide = kind(("fecha", "date"), ("k", "integer"), ("valor_total", "numeric"))
    assert build_table(spark, table, wide) == ["fecha"]
    assert build_table(spark, table, wide) == []
    later = spark.createDataFrame([(date(2024, 3, 3), *row[:2], 11, *row[3:])], wide.struct())
    append_to_table(later, table)
    append_to_table(batch.withColumn("id", F.lit(12).cast("long")), table)
    found = {x["id"]: (x["k"], x["fecha"]) for x in spark.table(table).collect()}
    assert found == {10: (1, None), 11: (1, date(2024, 3, 3)), 12: (1, None)}


def test_names_like_base_columns():
    assert r.column_names(["a", "id", "uuid"]) == {"a": "a", "id": "id_prop", "uuid": "uuid_prop"}
    assert r.column_names(["id", "id_prop"]) == {"id": "id_prop", "id_prop": "id_prop_prop"}
    assert r.column_names(["id_property", "uuid_prop_prop"]) == {
        "id_property": "id_property",
        "uuid_prop_prop": "uuid_prop_prop_prop",
    }
    assert r.column_names(["email", "name"]) == {"email": "email", "name": "name"}


def test_column_keeps_its_name_when_another_is_registered(spark):
    schemas = spark.createDataFrame([(1, "a", "A", 2)], "id long, name string, help_name string, db_status int")
    shape = "id long, event_id long, name string, help_name string, type string"
    rows = [(1, 1, "id", "ID", "integer"), (2, 1, "id_prop", "ID Prop", "varchar")]
    for some in (rows[:1], rows):
        (found,) = r.load_event_types(schemas, spark.createDataFrame(some, shape))
        assert found.columns[0].column == "id_prop"
        assert len(set(found.struct().names)) == len(found.struct().names)
    assert found.columns[1].column == "id_prop_prop"
    listed = wide_table_schema(schemas, spark.createDataFrame(rows, shape)).collect()
    assert [x["column_name"] for x in sorted(listed, key=lambda x: x["position"])] == found.struct().names


def test_event_types_by_name_else_by_spelling(spark):
    """Discovery and validation resolve an event name alike."""
    schemas = spark.createDataFrame(
        [
            (1, "compra", "PURCHASE", 2),
            (2, "signup", "SIGNUP", 2),
            (3, "alta", "Sign|up", 2),  # its spelling is the name of another type
            (4, "closed", "OLD ONE", 5),
            (5, "later", "OLD ONE", 2),  # so spelt first by a type that is closed
            (6, "buy", "PURCHASE", 2),
        ],
        "id long, name string, help_name string, db_status int",
    )
    props = spark.createDataFrame([], "id long, event_id long, name string, help_name string, type string")
    types = r.load_event_types(schemas, props)
    names = ["PURCHASE", "Purchase", "COMPRA", "Sign|up", "SIGNUP", "OLD ONE", "buy", None]
    events = spark.createDataFrame(list(enumerate(names)), "id long, name string")
    found = {x["id"]: x["type_id"] for x in r.with_event_type(events, types).collect()}
    assert found == {0: 1, 2: 1, 3: 2, 4: 2, 6: 6}
    open_ids = {kind.id for kind in types}
    resolved = {x["id"]: x["schema_id"] for x in with_schema_id(events, schemas).collect()}
    assert found == {i: s for i, s in resolved.items() if s in open_ids}


def test_registry_bound(spark):
    schemas = spark.createDataFrame([(1, "a", 2)], "id long, name string, db_status int")
    rows = [(i, 1, f"p{i}", "varchar") for i in range(5)]
    props = spark.createDataFrame(rows, "id long, event_id long, name string, type string")
    (found,) = r.load_event_types(schemas, props)
    assert [c.column for c in found.columns] == [f"p{i}" for i in range(5)]
    with pytest.raises(ValueError):
        r.load_event_types(schemas, props, max_declared=4)


def test_event_type_without_columns(spark):
    schemas = spark.createDataFrame([(1, "a", 2), (2, "b", 5)], "id long, name string, db_status int")
    props = spark.createDataFrame([], "id long, event_id long, name string, type string")
    assert r.load_event_types(schemas, props) == [r.EventType(1, "a", ())]


def test_registry_rows_of_one_name_are_one_type(spark):
    schemas = spark.createDataFrame([(4, "Sign Up", 2), (9, "sign_up", 2)], "id long, name string, db_status int")
    props = spark.createDataFrame(
        [(1, 9, "K", "integer"), (2, 4, "k", "varchar"), (3, 9, "d", "date")],
        "id long, event_id long, name string, type string",
    )
    (found,) = r.load_event_types(schemas, props)
    assert (found.id, found.name) == (4, "sign_up")
    assert [(c.column, c.type) for c in found.columns] == [("d", "date"), ("k", "varchar")]


def test_odd_column_names(spark):
    table = "wide_odd"
    odd = kind(("utm.source", "varchar"))
    build_table(spark, table, odd)
    more = kind(("a`b", "integer"), ("utm.source", "varchar"))
    assert build_table(spark, table, more) == ["a`b"]
    row = (5, "mail", 10, date(2024, 1, 2), date(2024, 1, 1), 7, 8, "sdk", "u")
    append_to_table(spark.createDataFrame([row], more.struct()), table)
    assert spark.table(table).first()["utm.source"] == "mail"


def test_status_codes():
    assert status_code("pending_create") == status_code("create_pending") == 2
    assert status_code("create_completed") == DB_STATUS["create_completed"] == 5


@pytest.mark.parametrize("name", TABLES)
def test_table_schemas(name):
    schema = table_schema(name)
    assert schema.names[0] in ("id", "event_id")


def test_append_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "wide")
    one = spark.createDataFrame([(1, "a"), (5, "b")], "id long, v string")
    two = spark.createDataFrame([(3, "c"), (5, "x"), (9, "d")], "id long, v string")
    for batch in (one, one, two, two, one.limit(0)):
        t.append_new(batch, path)
    assert {tuple(x) for x in spark.read.parquet(path).collect()} == {(1, "a"), (5, "b"), (3, "c"), (9, "d")}


def test_snapshot_never_overwrites(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a")], "id long, v string")
    path = str(tmp_path / "s")
    assert t.write_snapshot(rows, path).collect() == rows.collect()
    with pytest.raises(Exception, match="already exists"):
        t.write_snapshot(rows, path)


def test_flags(spark):
    status = spark.createDataFrame(
        [(1, "unvalid", None, 1), (1, "validated", None, 2), (1, None, True, 3), (2, "unvalid", False, 1), (2, None, None, 2)],
        table_schema("event_status"),
    )
    assert {tuple(x) for x in t.current_flags(status).collect()} == {
        (1, "validated", True),
        (2, "unvalid", False),
    }
    events = spark.createDataFrame(
        [(1, None, False), (2, "validated", True), (3, "validated", None)],
        "id long, valid string, migrated boolean",
    )
    assert {tuple(x) for x in t.with_flags(events, status).collect()} == {
        (1, "validated", True),
        (2, "unvalid", False),
        (3, "validated", None),
    }


def test_within_ids(spark):
    rows = spark.range(100).withColumnRenamed("id", "event_id")
    ids = spark.createDataFrame([(7,), (9,)], "id long")
    assert {x[0] for x in t.within_ids(rows, "event_id", ids).collect()} == {7, 8, 9}
    assert t.within_ids(rows, "event_id", ids.limit(0)).count() == 0


def test_tenant_tables(spark, tmp_path):
    store = t.TenantTables(spark, str(tmp_path), "acme")
    assert not store.exists("user_property")
    rows = spark.createDataFrame([(1, "a", "b", 2)], table_schema("user_property"))
    rows.write.parquet(store.path("user_property"))
    assert store.exists("user_property")
    assert store.read("user_property").collect() == rows.collect()
    assert not t.TenantTables(spark, str(tmp_path), "other").exists("user_property")
    path = store.wide_path("pedido_1/2 ñ")
    t.append_new(rows, path)
    t.append_new(rows, path)
    assert spark.read.parquet(path).count() == 1 and not t.path_exists(spark, store.wide_path("pedido_1"))


def test_jdbc_ranges():
    options = t.jdbc_options("jdbc:postgresql://host/db", "user_event", 0, 1000, 8)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "8"
    assert (options["lowerBound"], options["upperBound"]) == ("0", "1000")


@pytest.mark.parametrize("most", [100, 2])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_attach_broadcast_or_salted(spark, most, how):
    facts = spark.range(3000).selectExpr("id", "case when id % 3 < 2 then 'hot' else string(id % 5) end as k")
    facts = facts.unionByName(spark.createDataFrame([(9000 + i, None) for i in range(50)], "id long, k string"))
    small = spark.createDataFrame([("hot", 1), ("2", 2), ("4", 3)], "k string, n int")
    found = attach(facts, small, ["k"], spread="id", how=how, max_rows=most, salts=8)
    expected = facts.join(small, "k", how)
    assert sorted(map(str, found.select("id", "k", "n").collect())) == sorted(
        map(str, expected.select("id", "k", "n").collect())
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ("_salt" in plan) == (most == 2)


def test_size_check(spark):
    rows = spark.createDataFrame([("x" * 100,)] * 10, "s string")
    assert fits_broadcast(rows, max_rows=10)
    assert not fits_broadcast(rows, max_rows=9)
    assert not fits_broadcast(rows, max_bytes=500)
    assert fits_broadcast(rows.limit(0))


def test_shared_folder_is_the_one_named(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


class Session:
    """What ``shared_dir`` asks of a session."""

    def __init__(self, master, named=None):
        self.conf = {} if named is None else {"spark.checkpoint.dir": named}
        self.sparkContext = type("Context", (), {"master": master})


def test_a_cluster_needs_a_shared_folder():
    assert shared_dir(Session("yarn", "hdfs://x/y/")) == "hdfs://x/y"
    with pytest.raises(ValueError):
        shared_dir(Session("yarn"))
    assert shared_dir(Session("local[2]")) == shared_dir(Session("local[2]"))


def test_appends_of_a_grown_table(spark, tmp_path):
    path = str(tmp_path / "grown")
    t.append_new(spark.createDataFrame([(1, "a")], "id long, v string"), path)
    grown = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id long, v string, n int")
    t.append_new(grown, path)
    found = spark.read.schema(grown.schema).parquet(path)
    assert {tuple(x) for x in found.collect()} == {(1, "a", None), (2, "b", 2)}
