"""Runs over what is new: whole results, pruned reads, late ids, crashes, versions."""

from datetime import datetime
from decimal import Decimal

import pytest
from compare import DATA
from test_jobs import store as stored_tables

from propfold.functions.numbers import order_key
from propfold.operators import fold, observed, validate
from propfold.operators.registry import load_event_types
from propfold.operators.versions import EXACT, number_text, read_rows, stored_struct
from propfold.plans import incremental, jobs
from propfold.sources.schemas import table_schema
from propfold.sources.store import Store
from propfold.sources.tables import TenantTables
from pyspark.sql import functions as F

NOW = datetime(2024, 5, 1)


def contents(rows):
    return sorted(map(str, rows.collect()))


def arrive(tables, source, events=None, properties=None):
    """Append some rows of another tenant's tables."""
    for name, where in (("user_event", events), ("event_property", properties)):
        if where is not None:
            source.read(name).where(where).write.mode("append").parquet(tables.path(name))


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    return stored_tables(spark, tmp_path_factory.mktemp("source"), "all")


@pytest.fixture(scope="module")
def whole(spark, source, tmp_path_factory):
    """Everything in one run, without the gate."""
    tables = fresh(spark, source, tmp_path_factory.mktemp("whole"), "whole")
    arrive(tables, source, "true", "true")
    return incremental.run_job(tables, 1, NOW, schema_gate=False)


def fresh(spark, source, base, tenant):
    tables = TenantTables(spark, str(base), tenant)
    for name in ("event_schema", "property_event_schema"):
        source.read(name).write.parquet(tables.path(name))
    for name in ("user_event", "event_property"):
        source.read(name).limit(0).write.parquet(tables.path(name))
    return tables


def wide_contents(found):
    out = {}
    for kind in incremental.event_types(found):
        out[kind.name] = contents(incremental.wide_table(found, kind))
    return out


def flag_contents(found):
    return contents(found.flags().select("id", "valid", "migrated"))


def test_one_run_equals_the_plain_job(spark, source, whole, tmp_path):
    plain = stored_tables(spark, tmp_path, "plain")
    types = jobs.event_job(plain, str(tmp_path / "out"), 1, NOW, schema_gate=False)
    found = {k.name: contents(jobs.wide_table(plain, k)) for k in types}
    assert found == wide_contents(whole)
    assert any(found.values())
    state = jobs.event_state(plain).select("id", "valid", "migrated")
    assert contents(incremental.event_flags(whole).select("id", "valid", "migrated")) == contents(state)


def test_many_runs_equal_one(spark, source, whole, tmp_path):
    tables = fresh(spark, source, tmp_path, "many")
    # Property rows before and after their event, late ids, and a run with nothing new.
    arrive(tables, source, "id % 3 = 0", "event_id % 3 = 0 and id % 2 = 0")
    incremental.run_job(tables, 1, NOW, schema_gate=False)
    arrive(tables, source, "id % 3 = 1", "event_id % 3 = 2")
    incremental.run_job(tables, 2, NOW, schema_gate=False)
    incremental.run_job(tables, 3, NOW, schema_gate=False)
    arrive(tables, source, "id % 3 = 2", "event_id % 3 = 1")
    found = incremental.run_job(tables, 4, NOW, schema_gate=False)
    arrive(tables, source, None, "event_id % 3 = 0 and id % 2 = 1")
    found = incremental.run_job(tables, 5, NOW, schema_gate=False)
    assert found.flags().count() == source.read("user_event").count()
    assert found.flags().select("id").distinct().count() == found.flags().count()
    # Events of two thirds are migrated before all their properties have come.
    later = "id % 3 = 2"
    for kind in incremental.event_types(found):
        one, two = (incremental.wide_table(s, kind).where(later) for s in (found, whole))
        assert contents(one) == contents(two)
    assert contents(found.flags().where(later)) == contents(whole.flags().where(later))
    names = contents(observed.added_counts(found.growing("observed")))
    assert names == contents(observed.observed_counts(source.read("user_event"), source.read("event_property")))


def test_very_many_types_equal_few(spark, source, whole, tmp_path, monkeypatch):
    monkeypatch.setattr(fold, "TYPES_PER_FOLD", 2)
    tables = fresh(spark, source, tmp_path, "masks")
    arrive(tables, source, "true", "true")
    found = incremental.run_job(tables, 1, NOW, schema_gate=False)
    assert len(incremental.event_types(found)) > 2
    assert wide_contents(found) == wide_contents(whole)
    assert flag_contents(found) == flag_contents(whole)


def test_kept_counts_give_the_gate(spark, source, whole):
    types = load_event_types(source.read("event_schema"), source.read("property_event_schema"))
    counts = observed.added_counts(whole.growing("observed"))
    events, properties = source.read("user_event"), source.read("event_property")
    assert contents(observed.gate(counts, types)) == contents(validate.schema_conformance(events, properties, types))


def test_gated_run_equals_gated_validation(spark, source, tmp_path):
    tables = fresh(spark, source, tmp_path, "gated")
    arrive(tables, source, "true", "true")
    found = incremental.run_job(tables, 1, NOW, names=["purchase", "signup", "click"])
    types = incremental.event_types(found, ["purchase", "signup", "click"])
    verdicts = validate.validate_events(source.read("user_event"), source.read("event_property"), types)
    judged = found.flags().where("valid is not null").join(
        source.read("user_event").where("not migrated").select("id"), "id", "left_semi"
    )
    assert contents(judged.select("id", "valid")) == contents(verdicts.select("id", "valid"))


def test_second_run_reads_no_old_rows(spark, source, whole):
    tables = whole.tables
    for name, kind in (("user_event", "events"), ("event_property", "properties")):
        rows = incremental.unseen(tables.read(name), whole.growing(f"seen_{kind}"))
        assert rows.count() == 0
        plan = rows._jdf.queryExecution().executedPlan().toString()
        pushed = plan[plan.index("PushedFilters") :]
        assert pushed.startswith("PushedFilters: [IsNotNull(id), Or(")
    plan = whole.pending()._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "state" in filters and "run" in filters and "pending" in filters
    before = wide_contents(whole)
    again = incremental.run_job(tables, 2, NOW, schema_gate=False)
    assert wide_contents(again) == before
    assert again.stored("new_properties", table_schema("event_property"), [2]).count() == 0
    folded = spark.read.parquet(again.path("folded/run=2", 0))
    assert folded.where("valid = 'unvalid'").count() == 0  # refused events are not judged again


def test_crash_leaves_nothing_and_may_be_repeated(spark, source, whole, tmp_path, monkeypatch):
    tables = fresh(spark, source, tmp_path, "crash")
    arrive(tables, source, "id % 2 = 0", "event_id % 2 = 0")
    first = incremental.run_job(tables, 1, NOW, schema_gate=False)
    flags, rows = flag_contents(first), wide_contents(first)
    arrive(tables, source, "id % 2 = 1", "event_id % 2 = 1")

    class Killed(Exception):
        pass

    def killed(*_args, **_more):
        raise Killed

    for step in ("keep_properties", "stored_rows", "observed_counts"):
        with monkeypatch.context() as patch:
            patch.setattr(incremental, step, killed)
            with pytest.raises(Killed):
                incremental.run_job(tables, 2, NOW, schema_gate=False)
        after = Store(tables)
        assert after.runs == [1]
        assert flag_contents(after) == flags and wide_contents(after) == rows
    with monkeypatch.context() as patch:  # rows and flags are written, the commit is not
        patch.setattr(Store, "commit", killed)
        with pytest.raises(Killed):
            incremental.run_job(tables, 2, NOW, schema_gate=False)
    assert flag_contents(Store(tables)) == flags and wide_contents(Store(tables)) == rows
    found = incremental.run_job(tables, 2, NOW, schema_gate=False)
    assert flag_contents(found) == flag_contents(whole)
    assert wide_contents(found) == wide_contents(whole)
    # A run that counts does nothing when it is started again.
    assert incremental.run_job(tables, 2, NOW, schema_gate=False).runs == [1, 2]


def test_runs_compaction_and_vacuum(spark, source, whole, tmp_path):
    tables = fresh(spark, source, tmp_path, "ten")
    for run in range(1, 7):
        arrive(tables, source, f"id % 6 = {run - 1}", f"event_id % 6 = {run - 1}")
        found = incremental.run_job(tables, run, NOW, schema_gate=False)
    events = source.read("user_event").count()
    flags, rows = flag_contents(found), wide_contents(found)
    assert len(flags) == events and rows == wide_contents(whole)
    assert flags == flag_contents(whole)
    found = incremental.compact_job(tables, 7)
    assert flag_contents(found) == flags and wide_contents(found) == rows
    assert [c.base for c in found.commits][-1] == 7
    removed = found.vacuum()
    assert any("event_state/run=3" in path for path in removed)
    found = Store(tables)
    assert flag_contents(found) == flags and wide_contents(found) == rows
    stored = spark.read.parquet(found.path("event_state"))
    assert stored.count() == events  # one row an event, however many runs there were
    again = incremental.run_job(tables, 8, NOW, schema_gate=False)
    assert flag_contents(again) == flags and wide_contents(again) == rows
    assert not any("run=8" in path for path in again.vacuum() if "new_" not in path and "folded" not in path)
    assert flag_contents(Store(tables)) == flags


def test_registry_goes_from_run_to_run_and_opens_the_gate(spark, source, tmp_path):
    tables = fresh(spark, source, tmp_path, "registry")
    arrive(tables, source, "true", "true")
    first = incremental.run_job(tables, 1, NOW)
    schemas, declared = first.registry()
    assert schemas.count() > source.read("event_schema").count()
    # A property that is taken out of the registry closes the gate of its type ...
    gone = declared.where("name <> 'fecha'")
    changed = incremental.change_registry(tables, 2, schemas, gone)
    types = load_event_types(*changed.registry())
    counts = observed.added_counts(changed.growing("observed"))
    shut = {r["schema"] for r in observed.gate(counts, types).where("not conforms").collect()}
    assert "purchase" in shut
    # ... and is found again by the next run, out of the kept counts alone.
    found = incremental.run_job(tables, 3, NOW)
    assert {r[0] for r in found.registry()[1].where("name = 'fecha'").select("type").collect()} == {"varchar"}
    counts = observed.added_counts(found.growing("observed"))
    gate = observed.gate(counts, incremental.event_types(found))
    assert gate.where("not conforms").isEmpty()
    assert found.stored("new_properties", table_schema("event_property"), [3]).count() == 0


def test_wide_table_over_two_versions(spark, source, tmp_path):
    tables = fresh(spark, source, tmp_path, "versions")
    arrive(tables, source, "id % 2 = 0", "event_id % 2 = 0")
    names = ["purchase"]
    schemas, declared = source.read("event_schema"), source.read("property_event_schema")
    purchase = schemas.where("name = 'purchase'").first()["id"]
    text = declared.withColumn("type", F.when(F.col("event_id") == purchase, "varchar").otherwise(F.col("type")))
    incremental.run_job(tables, 1, NOW, schema_gate=False, names=names)
    incremental.change_registry(tables, 2, Store(tables).registry()[0], with_types(Store(tables).registry()[1], text))
    arrive(tables, source, "id % 2 = 1", "event_id % 2 = 1")
    found = incremental.run_job(tables, 3, NOW, schema_gate=False, names=names)
    (kind,) = incremental.event_types(found, names)
    assert {c.type for c in kind.columns} == {"varchar"}
    rows = incremental.wide_table(found, kind)
    assert rows.schema == kind.struct()
    odd, even = rows.where("id % 2 = 1").count(), rows.where("id % 2 = 0").count()
    assert odd > 0 and even > 0
    assert rows.where("valor_total like '%000'").isEmpty()
    versions = found.growing("wide_columns").where("event_type = 'purchase'").select("version").distinct()
    assert versions.count() == 2
    # Back again: what fits the old types is read as them, the rest is NULL.
    back = with_types(found.registry()[1], declared)
    incremental.change_registry(tables, 4, found.registry()[0], back)
    found = incremental.run_job(tables, 5, NOW, schema_gate=False, names=names)
    (kind,) = incremental.event_types(found, names)
    assert {c.type for c in kind.columns} >= {"numeric", "date"}
    rows = incremental.wide_table(found, kind)
    assert rows.schema == kind.struct() and rows.count() >= odd + even
    assert rows.where("id % 2 = 0 and valor_total is not null").count() > 0
    assert rows.where("id % 2 = 1 and valor_total is not null").count() > 0


ODD_NUMBERS = {
    0: ("-123456789012345678901", "-1.23456789012345678901e20"),
    1: ("1e-30", "1e-30"),
    2: ("0,12345678901234567891", "1.2345678901234567891e-1"),
    3: ("5e25", "5e25"),
    4: ("12.50", None),
    5: ("-0e99", None),
}


def test_numbers_of_any_size_reach_the_wide_table(spark, source, tmp_path):
    tables = fresh(spark, source, tmp_path, "numbers")
    arrive(tables, source, "id % 2 = 0")
    raw = F.lit(None).cast("string")
    for place, (text, _) in ODD_NUMBERS.items():
        raw = F.when(F.pmod("event_id", F.lit(12)) == 2 * place, text).otherwise(raw)
    rows = source.read("event_property").where("event_id % 2 = 0 and name <> 'Valor Total'")
    rows = rows.withColumn("value", F.when(F.col("name") == "VALOR TOTAL", raw).otherwise(F.col("value")))
    rows.write.mode("append").parquet(tables.path("event_property"))
    names = ["purchase"]
    found = incremental.run_job(tables, 1, NOW, schema_gate=False, names=names)
    (kind,) = incremental.event_types(found, names)
    assert {c.column: c.type for c in kind.columns}["valor_total"] == "numeric"
    assert incremental.wide_table(found, kind).schema == kind.struct()
    wide = incremental.wide_table(found, kind, exact=True)
    exact = F.try_element_at(EXACT, F.lit("valor_total"))
    text = number_text(F.col("valor_total"), exact)
    seen = set()
    for r in wide.select("id", "valor_total", exact.alias("exact"), text.alias("text")).collect():
        if r["valor_total"] is None and r["exact"] is None:
            continue
        place = r["id"] % 12 // 2
        seen.add(place)
        assert r["exact"] == ODD_NUMBERS[place][1], r
        assert Decimal(r["text"]) == Decimal(ODD_NUMBERS[place][0].replace(",", "."))
    assert seen == set(ODD_NUMBERS)
    by_size = wide.where(text.isNotNull()).orderBy(order_key(text)).select(text.alias("text")).collect()
    numbers = [Decimal(r["text"]) for r in by_size]
    assert numbers == sorted(numbers)
    # Declared as text by a later registry, all digits are still there.
    schemas, declared = found.registry()
    as_text = declared.withColumn("type", F.lit("varchar"))
    found = incremental.change_registry(tables, 2, schemas, as_text)
    (kind,) = incremental.event_types(found, names)
    history = {c.property: {"numeric", "date", "integer", "varchar"} for c in kind.columns}
    schema = stored_struct(kind, history).add("event_type", "string")
    later = read_rows(found.stored("wide", schema, [1]), kind, history)
    expected = {str(Decimal(t.replace(",", ".")).normalize()) for t, _ in ODD_NUMBERS.values()}
    texts = {r[0] for r in later.where("valor_total is not null").select("valor_total").distinct().collect()}
    assert {str((Decimal(t) + 0 if Decimal(t) else Decimal(0)).normalize()) for t in texts} == {
        "0" if Decimal(t) == 0 else t for t in expected
    }


def with_types(declared, like):
    """Declared properties with the types that another registry gives to their ids."""
    types = like.select("id", F.col("type").alias("_type"))
    return (
        declared.join(types, "id", "left").withColumn("type", F.coalesce("_type", "type")).select(*declared.columns)
    )


def test_jobs_do_not_grow_with_types(spark, source, tmp_path):
    counts, types = [], 0
    for names in (["purchase", "signup"], None):
        tables = fresh(spark, source, tmp_path, f"types{len(counts)}")
        arrive(tables, source, "id < 300", "event_id < 300")
        group = f"count-{len(counts)}"
        spark.sparkContext.setJobGroup(group, group)
        found = incremental.run_job(tables, 1, NOW, schema_gate=False, names=names)
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)))
        types = len(incremental.event_types(found))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Two small jobs a type and more, as there were before, would make a greater difference.
    assert types >= 5 and abs(counts[0] - counts[1]) < 2 * (types - 2)


def test_runs_go_upwards(spark, source, whole):
    with pytest.raises(ValueError, match="after run"):
        incremental.run_job(whole.tables, 0, NOW)
    with pytest.raises(ValueError, match="must follow"):
        incremental.compact_job(whole.tables, 0)
