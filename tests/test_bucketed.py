"""Bucketed catalog tables: no shuffle, same rows, and a way round a hot bucket."""

import re

import pytest
from test_fold import kinds, tables

from propfold.operators.pivot import fold_events
from propfold.plans import jobs
from propfold.sources.schemas import table_schema
from propfold.sources.tables import CatalogTables, bucket_excess, write_bucketed
from pyspark.sql import functions as F


def plan(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def save(spark, database, types, hot):
    events, properties, _, _ = tables(spark, types, events=1500, hot=hot)
    spark.sql(f"CREATE DATABASE {database}")
    properties = properties.withColumns(
        {name: F.lit(None).cast("timestamp_ntz") for name in ("created_at", "updated_at")}
    ).select(*table_schema("event_property").names)
    write_bucketed(events, f"{database}.user_event", "id", 8)
    write_bucketed(properties, f"{database}.event_property", "event_id", 8)
    return events, properties


@pytest.mark.parametrize("hot", [False, True])
def test_bucketed_tables(spark, tmp_path, hot):
    database = f"acme_{hot}".lower()
    types = kinds(3)
    events, properties = save(spark, database, types, hot)
    store = CatalogTables(spark, str(tmp_path), database, max_bucket_excess=2.0)
    assert (bucket_excess(spark, store.name("event_property")) > 2.0) == hot
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = fold_events(
            store.read("user_event"), store.read("event_property"), types, schema_gate=False
        )
        shuffles = re.findall(r"Exchange hashpartitioning\((?:event_id|id)#", plan(rows))
        assert bool(shuffles) == hot
        expected = fold_events(events, properties, types, schema_gate=False)
        assert sorted(map(str, rows.collect())) == sorted(map(str, expected.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_job_over_catalog_tables(spark, tmp_path):
    types = kinds(2)
    save(spark, "acme_job", types, hot=False)
    store = CatalogTables(spark, str(tmp_path), "acme_job")
    assert store.exists("user_event") and not store.exists("event_status")
    status = jobs.migrate_events_job(store, types, 1, schema_gate=False)
    written = sum(jobs.wide_table(store, kind).count() for kind in types)
    assert written == status.where("migrated").count() > 0
    again = jobs.migrate_events_job(store, types, 2, schema_gate=False)
    assert again.where("migrated").count() == 0
    assert sum(jobs.wide_table(store, kind).count() for kind in types) == written
