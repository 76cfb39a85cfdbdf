"""The jobs over stored tables: whole results, repeatable, and after a crash."""

from datetime import datetime

import pytest
from compare import DATA

from propfold.operators import clean, pivot, validate
from propfold.operators.fold import cell
from propfold.operators.registry import load_event_types
from propfold.plans import jobs
from propfold.sources import given
from propfold.sources.schemas import IDENTIFIED_COLUMNS, table_schema
from propfold.sources.tables import TenantTables, append_new, current_flags
from pyspark.sql import functions as F

FOLDER = f"{DATA}/sf0.001"
NOW = datetime(2024, 5, 1)


def store(spark, base, tenant):
    tables = TenantTables(spark, str(base), tenant)
    for name, derive in given.DERIVED.items():
        rows = derive(spark, FOLDER)
        for field in table_schema(name):
            if field.name not in rows.columns:
                rows = rows.withColumn(field.name, F.lit(None).cast(field.dataType))
        rows.select(*(F.col(f.name).cast(f.dataType) for f in table_schema(name))).write.parquet(
            tables.path(name)
        )
    return tables


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    return store(spark, tmp_path_factory.mktemp("tenants"), "acme")


def registered_types(tables, *names):
    return load_event_types(
        tables.read("event_schema"), tables.read("property_event_schema"), names
    )


def contents(rows):
    return sorted(map(str, rows.collect()))


def test_event_job(spark, tables, tmp_path):
    types = jobs.event_job(tables, str(tmp_path / "one"), 1, NOW, schema_gate=False)
    names = {k.name for k in types}
    assert {"click", "pedido_p", "purchase"} <= names and "view" not in names
    status = tables.read("event_status")
    first = status.count()
    pending = tables.read("user_event").where(~F.col("migrated"))
    assert status.select("event_id").distinct().count() == first
    assert first == pending.where(F.col("name") != "VIEW").count()
    migrated = 0
    for kind in types:
        rows = jobs.wide_table(tables, kind)
        assert rows.columns == kind.struct().names
        ids = {r["id"] for r in rows.select("id").collect()}
        assert len(ids) == rows.count()
        migrated += len(ids)
    assert migrated == status.where("migrated").count() > 0
    before = {k.name: contents(jobs.wide_table(tables, k)) for k in types}
    # The same again: refused events are looked at once more, none is appended.
    jobs.event_job(tables, str(tmp_path / "two"), 2, NOW, schema_gate=False)
    assert {k.name: contents(jobs.wide_table(tables, k)) for k in types} == before
    second = tables.read("event_status").where("run_id = 2")
    assert second.count() == first - migrated
    assert second.where("migrated").count() == 0
    state = jobs.event_state(tables)
    assert state.where((F.col("valid") == "validated") & F.col("migrated")).count() == migrated
    assert state.count() == tables.read("user_event").count()


def test_refusals_job(spark, tmp_path):
    tables = store(spark, tmp_path, "refusals")
    types = registered_types(tables, "purchase", "signup")
    jobs.validate_job(tables, types, 31, schema_gate=False)
    found = jobs.refusals_job(tables, types, str(tmp_path / "refused"))
    refused = tables.read("event_status").where("valid = 'unvalid'")
    assert found.select("event_id").distinct().count() == refused.count() > 0
    whole = validate.refused_properties(tables.read("user_event"), tables.read("event_property"), types)
    assert contents(found) == contents(whole)


def test_crash_between_append_and_flags(spark, tmp_path):
    tables = store(spark, tmp_path, "crash")
    whole = store(spark, tmp_path, "whole")
    types = registered_types(whole, "purchase", "pedido_f")
    jobs.migrate_events_job(whole, types, 11, schema_gate=False)
    folded = pivot.fold_events(tables.read("user_event"), tables.read("event_property"), types, schema_gate=False)
    purchase = next(k for k in types if k.name == "purchase")
    append_new(pivot.pivot_folded(folded, types, purchase), tables.path("wide/purchase"))
    assert not tables.exists("event_status")
    jobs.migrate_events_job(tables, types, 12, schema_gate=False)
    for kind in types:
        assert contents(jobs.wide_table(tables, kind)) == contents(jobs.wide_table(whole, kind))
    assert tables.read("event_status").count() == whole.read("event_status").count()


def test_steps_one_by_one_equal_the_whole(spark, tmp_path):
    steps, whole = store(spark, tmp_path, "steps"), store(spark, tmp_path, "fused")
    types = registered_types(steps, "purchase", "documento_leido")
    jobs.validate_job(steps, types, 1, schema_gate=False)
    for run_id, kind in enumerate(types, start=2):
        jobs.pivot_job(steps, kind, run_id)
        assert contents(jobs.pivot_job(steps, kind, run_id)) == contents(jobs.wide_table(steps, kind))
    jobs.migrate_events_job(whole, types, 1, schema_gate=False)
    for kind in types:
        assert contents(jobs.wide_table(steps, kind)) == contents(jobs.wide_table(whole, kind))
    assert contents(current_flags(steps.read("event_status"))) == contents(
        current_flags(whole.read("event_status"))
    )


def test_rebalanced_staging_gives_the_same(spark, tmp_path, monkeypatch):
    one, two = store(spark, tmp_path, "plain"), store(spark, tmp_path, "rebalanced")
    types = registered_types(one, "purchase", "pedido_f")
    jobs.migrate_events_job(one, types, 1, schema_gate=False)
    monkeypatch.setattr(jobs, "MAX_STAGED_FILES", 1)
    jobs.migrate_events_job(two, types, 1, schema_gate=False)
    for kind in types:
        assert contents(jobs.wide_table(one, kind)) == contents(jobs.wide_table(two, kind))


def test_cleaning_jobs(spark, tables, tmp_path):
    found = jobs.clean_events_job(tables, "PURCHASE", "VALOR%", clean.remove_dollar, str(tmp_path))
    assert found.count() == tables.read("event_property").count()
    changed = found.exceptAll(tables.read("event_property"))
    assert changed.count() > 0 and changed.where("name <> 'VALOR TOTAL' or value like '%$%'").count() == 0
    found = jobs.clean_users_job(tables, "CANTIDAD%", clean.remove_space, str(tmp_path))
    assert found.exceptAll(tables.read("user_property")).where("value like '% %'").count() == 0


def test_gate_keeps_types_out(spark, tmp_path):
    tables = store(spark, tmp_path, "gate")
    types = registered_types(tables, "purchase", "signup")
    jobs.migrate_events_job(tables, types, 21)
    names = {k.name: jobs.wide_table(tables, k).count() for k in types}
    assert names["signup"] == 0 and names["purchase"] > 0
    gated = validate.validate_events(tables.read("user_event"), tables.read("event_property"), types)
    assert tables.read("event_status").count() == gated.count()


def test_discovered_names_make_the_gate_open(spark, tables, tmp_path):
    schemas, declared = jobs.discover_job(tables, str(tmp_path / "found"), NOW)
    types = load_event_types(schemas, declared)
    gate = validate.schema_conformance(tables.read("user_event"), tables.read("event_property"), types)
    assert {r["conforms"] for r in gate.collect()} == {True}
    assert schemas.select("id").distinct().count() == schemas.count()
    assert declared.select("id").distinct().count() == declared.count()


def test_user_job(spark, tables, tmp_path):
    found = jobs.user_job(tables, str(tmp_path / "users"))
    users = found["user_company"]
    assert users.count() == tables.read("user_company").count()
    assert {"cantidad_cortesia", "nickname"} <= set(users.columns)
    assert users.where("nickname is not null").count() > 0
    assert users.where("cantidad_cortesia is not null").count() == 0
    target = spark.read.parquet(tables.path("user_identificated"))
    assert target.columns == IDENTIFIED_COLUMNS
    assert target.count() == target.select("id").distinct().count()
    assert users.where("migrate = 'migrated'").count() >= target.count() > 0
    statuses = {r["name"]: (r["db_status"], r["migrate_status"]) for r in found["property_user_schema"].collect()}
    assert statuses["cantidad_cortesia"] == ("create_completed", "migrate_completed")
    before = tables.read("user_property").count()
    assert 0 < found["user_property"].count() < before
    jobs.user_job(tables, str(tmp_path / "again"))
    assert spark.read.parquet(tables.path("user_identificated")).count() == target.count()


def test_cell_text(spark):
    rows = spark.createDataFrame([({"a": "1"},)], "cells map<string, string>")
    assert rows.select(cell(rows.columns, ["a", "b"], "a"), cell(rows.columns, ["a", "b"], "b")).first()[:] == ("1", None)
