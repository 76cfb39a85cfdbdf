"""A property table in parts: changes rewrite what they touch, and count as a whole."""

import pytest
from test_jobs import store as stored_tables

from propfold.operators import clean
from propfold.operators.scans import ids_of_events, ids_of_incomplete_users
from propfold.plans import rewrites
from propfold.sources.parts import NamedParts
from pyspark.sql import functions as F


def contents(rows):
    return sorted(map(str, rows.collect()))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    return stored_tables(spark, tmp_path_factory.mktemp("parts"), "acme")


def test_a_change_rewrites_its_parts_only(spark, tables):
    parts = rewrites.split_job(tables, "event_property", 1)
    raw = tables.read("event_property")
    assert contents(parts.read()) == contents(raw)
    touched = rewrites.clean_job(parts, "VALOR TOTAL", clean.remove_dollar, 2, "PURCHASE")
    assert len(touched) == 1 and set(parts.runs().values()) == {1, 2}
    assert [p for p, run in parts.runs().items() if run == 2] == touched
    written = spark.read.parquet(f"{parts.path('rows')}/run=2")
    assert {r["part"] for r in written.select("part").distinct().collect()} == set(touched)
    owners = ids_of_events(tables.read("user_event"), "PURCHASE")
    wanted = clean.clean_values(raw, owners, "VALOR TOTAL", clean.remove_dollar)
    assert contents(parts.read()) == contents(wanted)
    plan = parts.read(touched)._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert "run" in filters and "part" in filters
    # The same run again does nothing; a pattern that no name is like touches nothing.
    assert rewrites.clean_job(parts, "VALOR TOTAL", clean.blank, 2, "PURCHASE") == []
    assert rewrites.clean_job(parts, "nothing like it", clean.blank, 3, "PURCHASE") == []
    assert contents(parts.read()) == contents(wanted)


def test_a_killed_change_is_not_seen(spark, tables, monkeypatch):
    parts = rewrites.split_job(tables, "user_property", 1)
    before = contents(parts.read())

    class Killed(Exception):
        pass

    def killed(*_args, **_more):
        raise Killed

    with monkeypatch.context() as patch:
        patch.setattr(F, "count", killed)  # rows are written, the manifest is not
        with pytest.raises(Killed):
            rewrites.clean_job(parts, "CANTIDAD%", clean.remove_space, 2)
    assert contents(parts.read()) == before
    assert rewrites.clean_job(parts, "CANTIDAD%", clean.remove_space, 2)
    owners = ids_of_incomplete_users(tables.read("user_company"))
    wanted = clean.clean_values(tables.read("user_property"), owners, "CANTIDAD%", clean.remove_space)
    assert contents(parts.read()) == contents(wanted)


def test_renamed_rows_move(spark, tables):
    parts = NamedParts(tables, "user_property")
    before = parts.read().cache()
    before.count()
    rewrites.rename_job(parts, "CANTIDAD%", "cantidad_cortesia", 3)
    owners = ids_of_incomplete_users(tables.read("user_company"))
    wanted = clean.rename_property(before, owners, "CANTIDAD%", "cantidad_cortesia")
    assert contents(parts.read()) == contents(wanted)
    names = {r["name"]: r["n"] for r in parts.manifest().where("n > 0").collect()}
    counted = {r["name"]: r["count"] for r in parts.read().groupBy("name").count().collect()}
    assert names == counted and "cantidad_cortesia" in names
