"""What the plans must and must not contain."""

import re
from datetime import datetime

import pytest
from compare import DATA
from pyspark.sql import functions as F

from propfold.functions.names import with_identifier
from propfold.operators import clean, discover, pivot, scans, users, validate
from propfold.operators.fold import fold
from propfold.operators.registry import EventType, WideColumn
from propfold.plans.queries import registered
from propfold.sources.schemas import table_schema

FOLDER = f"{DATA}/sf0.001"
KIND = EventType(1, "purchase", (WideColumn("fecha", "fecha", "date"), WideColumn("k", "k", "integer")))


def physical(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


def final(rows) -> str:
    rows.write.format("noop").mode("overwrite").save()
    rows.collect()
    return physical(rows)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Stored tables in which one event holds a third of the property rows."""
    base = str(tmp_path_factory.mktemp("stored"))
    events = spark.range(0, 20_000, 1, 4).selectExpr(
        "id", "'PURCHASE' as name", "string(null) as value", "string(null) as email",
        "'validated' as valid", "id % 2 = 0 as migrated", "id as user_id",
        "timestamp_ntz'2024-01-01 00:00:00' as created_at",
        "timestamp_ntz'2024-01-01 00:00:00' as updated_at",
        "id as integration_id", "'sdk' as integration_type", "uuid() as uuid",
    )
    props = spark.range(0, 120_000, 1, 6).selectExpr(
        "id", "if(id % 2 = 0, 'K', 'FECHA') as name",
        "if(id % 5 = 0, 'broken', if(id % 2 = 0, string(id), '2024-01-01')) as value",
        "if(id % 3 = 0, 1, id % 20000) as event_id",
        "timestamp_ntz'2024-01-01 00:00:00' as created_at",
        "timestamp_ntz'2024-01-01 00:00:00' as updated_at",
    )
    events.select(*table_schema("user_event").names).write.parquet(f"{base}/user_event")
    props.select(*table_schema("event_property").names).write.parquet(f"{base}/event_property")
    return (
        spark.read.schema(table_schema("user_event")).parquet(f"{base}/user_event"),
        spark.read.schema(table_schema("event_property")).parquet(f"{base}/event_property"),
    )


@pytest.mark.parametrize("name", sorted(registered()))
def test_no_query_leaves_the_engine_or_crosses_tables(spark, name):
    plan = physical(registered()[name](spark, FOLDER))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Python|MapInPandas|InArrow", plan)


def exchanges(plan: str, key: str) -> int:
    return len(re.findall(rf"Exchange hashpartitioning\({key}#", plan))


def test_fold_shuffles_once_after_combining(spark, stored):
    _, props = stored
    plan = physical(fold(props, [KIND], ["k", "fecha"], verdicts=True))
    assert exchanges(plan, "event_id") == 1
    after, before = plan.split("Exchange hashpartitioning(event_id", 1)
    assert "partial_bit_and" in before and "partial_max(" in before


def test_verdicts_alone_use_hash_aggregation(spark, stored):
    _, props = stored
    plan = physical(fold(props, [KIND], verdicts=True))
    assert "SortAggregate" not in plan and "partial_bit_and" in plan


def test_a_thousand_event_types_take_one_pass(spark, stored):
    events, props = stored
    types = [EventType(n, f"type_{n}", (WideColumn("a", "a", "integer"),)) for n in range(1000)]
    for rows in (
        validate.validate_events(events, props, types, schema_gate=False),
        pivot.fold_events(events, props, types, schema_gate=False),
    ):
        plan = physical(rows)
        assert plan.count("FileScan") == 2  # the events and the properties
        assert exchanges(plan, "event_id") <= 2


def test_pivot_shuffles_each_table_once(spark, stored):
    events, props = stored
    plan = physical(pivot.fold_events(events, props, [KIND], schema_gate=False))
    assert exchanges(plan, "event_id") == 1 and exchanges(plan, "id") == 1
    joins = re.findall(r"(SortMergeJoin|ShuffledHashJoin)", plan)
    assert len(joins) == 1


def test_gate_reuses_the_fold(spark, stored):
    events, props = stored
    plan = final(validate.validate_events(events, props, [KIND]))
    assert "ReusedExchange" in plan


def read_schemas(plan: str) -> list[set[str]]:
    return [
        set(re.findall(r"(\w+):", found)) for found in re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    ]


def test_scans_are_pruned_and_filtered(spark, stored):
    events, props = stored
    plan = physical(scans.observed_properties(events, props))
    assert sorted(map(sorted, read_schemas(plan))) == [["event_id", "name"], ["id", "name"]]
    plan = physical(scans.pending_events(events, "PURCHASE"))
    assert "EqualTo(name,PURCHASE)" in plan and "Not(EqualTo(migrated,true))" in plan
    plan = physical(validate.validate_events(events, props, [KIND], schema_gate=False))
    assert "created_at" not in plan and "Not(EqualTo(migrated,true))" in plan
    # Names come from the registry: one scan of each table.
    assert len(read_schemas(plan)) == 2


@pytest.mark.parametrize("known", [{}, {"K": "k"}])
def test_names_are_normalised_in_one_scan(spark, stored, known):
    _, props = stored
    plan = physical(with_identifier(props.select("id", "name"), "name", "clean", known))
    assert {frozenset(s) for s in read_schemas(plan)} == {frozenset(["id", "name"])}
    assert len(read_schemas(plan)) == 1 and "GlobalLimit" not in plan and "Exchange hash" not in plan


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}


@pytest.fixture
def skewed(spark):
    before = {key: spark.conf.get(key, None) for key in SKEW}
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.mark.parametrize(
    "query",
    [
        lambda e, p: validate.refused_properties(e, p, [KIND]),
        lambda e, p: scans.observed_properties(e, p),
        lambda e, p: scans.properties_like(e, p, "PURCHASE", "K"),
        lambda e, p: clean.clean_values(p, scans.ids_of_events(e, "PURCHASE"), "K", clean.blank),
        lambda e, p: clean.clean_declared_values(e, p, [KIND]),
    ],
)
def test_hot_event_is_split_over_tasks(spark, stored, skewed, query):
    rows = query(*stored)
    rows.collect()
    assert "isSkew=true" in physical(rows) or "skew=true" in physical(rows)


def test_hot_user_is_split_over_tasks(spark, stored, skewed):
    _, props = stored
    people = spark.range(20_000).selectExpr("id", "string(null) as K")
    owned = props.withColumnRenamed("event_id", "user_id").select("id", "name", "value", "user_id")
    rows = users.unconsolidated_properties(owned, users.consolidation(people, owned))
    rows.collect()
    assert "isSkew=true" in physical(rows) or "skew=true" in physical(rows)


def test_hot_event_leaves_each_task_as_one_row(spark, stored):
    """What is shuffled is bounded by map tasks times events, not by properties."""
    _, props = stored
    hot = props.where(F.col("event_id") == 1)
    folded = fold(hot, [KIND], ["k", "fecha"], verdicts=True)
    folded.collect()
    plan = folded._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "partial_max(" in text
    assert folded.count() == 1 and hot.count() > 40_000


def test_known_names_are_looked_up_per_spelling(spark, stored):
    """The registry meets the distinct names, not every event."""
    events, _ = stored
    known = spark.createDataFrame([(1, "purchase", "PURCHASE")], "id long, name string, help_name string")
    plan = physical(discover.discover_event_schemas(events, known, datetime(2024, 1, 1)))
    joins = [m.start() for m in re.finditer("Join", plan)]
    assert joins and plan.index("partial_min(id") > max(joins)
