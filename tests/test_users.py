import random
from collections import defaultdict

from propfold.operators import users as u
from pyspark.sql import functions as F

NAMES = ["email", "city", "nickname", "score"]


def tables(spark, seed=1, count=150):
    pick = random.Random(seed)
    people, props = [], []
    for i in range(count):
        people.append((i, pick.choice([None, "a", "b"]), pick.choice([None, "x"]), pick.choice([None, 3])))
        for name in NAMES:
            for _ in range(pick.choice([0, 0, 1, 1, 2, 3])):
                props.append((name, pick.choice([None, "", "a", "b", "3"]), i))
    # One user holds a third of all rows of one property; one user is unknown.
    props += [("email", "a", 0)] * (len(props) // 2) + [("email", "a", count + 5)]
    pick.shuffle(props)
    props = [(i, *p) for i, p in enumerate(props)]
    return (
        spark.createDataFrame(people, "id long, email string, city string, score int"),
        spark.createDataFrame(props, "id long, name string, value string, user_id long").repartition(5),
        {p[0]: dict(zip(["email", "city", "score"], p[1:], strict=True)) for p in people},
        props,
    )


def by_hand(people, props):
    grouped = defaultdict(list)
    for _, name, value, user in props:
        grouped[user, name].append(value)
    outcome = {}
    for (user, name), values in grouped.items():
        distinct = {x for x in values if x}
        current = people.get(user, {}).get(name)
        current = None if current is None else str(current)
        if len(distinct) > 1:
            act, after = "conflict", current
        elif not distinct:
            act, after = "drop_empty", current
        elif name not in ("email", "city", "score"):
            act, after = "no_column", None
        elif user not in people:
            act, after = "no_user", None
        else:
            (single,) = distinct
            if name == "score" and not single.isdigit():
                act, after = "misfit", current
            elif current == single:
                act, after = "already_equal", current
            else:
                act, after = ("fill" if current is None else "overwrite"), single
        outcome[user, name] = (act, after, len(values))
    return outcome


def test_consolidation(spark):
    users, props, people, rows = tables(spark)
    expected = by_hand(people, rows)
    found = u.consolidation(users, props)
    collected = found.collect()
    assert {(r["user_id"], r["name"]): (r["action"], r["new_value"], r["n_rows"]) for r in collected} == expected
    assert len(collected) == len(expected)
    assert {e[0] for e in expected.values()} == {
        "conflict", "drop_empty", "no_column", "no_user", "misfit", "already_equal", "fill", "overwrite",
    }
    after = {r["id"]: r for r in u.consolidated_users(users, props).collect()}
    assert len(after) == len(people)
    for (user, name), (act, value, _) in expected.items():
        if act in ("fill", "overwrite"):
            assert str(after[user][name]) == value
        elif user in people and name != "nickname":
            assert after[user][name] == people[user][name]
    left = u.unconsolidated_properties(props, found)
    kept = [r for r in rows if expected[r[3], r[1]][0] not in u.CONSUMING]
    assert sorted(r["id"] for r in left.collect()) == sorted(r[0] for r in kept)


def test_consolidation_of_some_names(spark):
    users, props, people, rows = tables(spark, seed=2)
    expected = {k: x for k, x in by_hand(people, rows).items() if k[1] == "city"}
    found = u.consolidation(users, props, ["city"]).collect()
    assert {(r["user_id"], r["name"]): (r["action"], r["new_value"], r["n_rows"]) for r in found} == expected
    after = {r["id"]: r["email"] for r in u.consolidated_users(users, props, ["city"]).collect()}
    assert after == {i: p["email"] for i, p in people.items()}


def test_consolidation_again_changes_nothing(spark):
    users, props, _, _ = tables(spark, seed=3)
    once = u.consolidated_users(users, props)
    left = u.unconsolidated_properties(props, u.consolidation(users, props))
    assert sorted(once.collect()) == sorted(u.consolidated_users(once, left).collect())
    actions = {r["action"] for r in u.consolidation(once, left).collect()}
    assert actions <= {"conflict", "no_column", "no_user", "misfit"}


def test_promotion(spark, monkeypatch):
    users, props, people, rows = tables(spark, seed=4)
    columns = {"nickname": "varchar", "score": "integer"}
    for per_fold in (64, 1):
        monkeypatch.setattr(u, "COLUMNS_PER_FOLD", per_fold)
        found = u.promote_user_properties(users, props, columns)
        assert found.columns == ["id", "email", "city", "score", "nickname"]
        latest = {}
        for _, name, value, user in sorted(rows):
            if name == "nickname" and value is not None:
                latest[user, name] = value
            if name == "score" and value == "3":
                latest[user, name] = 3
        for r in found.collect():
            assert r["nickname"] == latest.get((r["id"], "nickname"))
            assert r["score"] == latest.get((r["id"], "score"), people[r["id"]]["score"])
    left = {r["id"] for r in u.unpromoted_properties(users, props, columns).collect()}
    used = {
        i for i, name, value, user in rows
        if user in people and ((name == "nickname" and value is not None) or (name == "score" and value == "3"))
    }
    assert left == {r[0] for r in rows} - used


def test_any_number_of_columns_takes_one_pass(spark):
    users, props, _, _ = tables(spark, seed=6)
    some = {"nickname": "varchar", "score": "integer"}
    columns = {**some, **{f"column {k}": "varchar" for k in range(200)}}
    found = u.promote_user_properties(users, props, columns)
    few = u.promote_user_properties(users, props, some)
    assert sorted(map(str, found.select(few.columns).collect())) == sorted(map(str, few.collect()))
    wide = users.withColumns({f"column {k}": F.lit(None).cast("string") for k in range(200)})
    settled = u.consolidated_users(wide, props)
    assert sorted(map(str, settled.select(users.columns).collect())) == sorted(
        map(str, u.consolidated_users(users, props).collect())
    )
    for rows in (found, settled):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        # one join with the users, two groupings of the properties: by name, by user
        assert plan.count("Join LeftOuter") <= 2 and plan.count("Aggregate [") == 2


def test_consolidation_by_map_equals_that_by_columns(spark):
    users, props, _, _ = tables(spark, seed=7)
    one, two = (u.consolidated_users(users, props, max_cell_columns=n) for n in (64, 1))
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))


def test_no_columns_to_promote(spark):
    users, props, _, rows = tables(spark, seed=5)
    assert u.promote_user_properties(users, props, {}).columns == users.columns
    assert u.unpromoted_properties(users, props, {}).count() == len(rows)


def test_registry_of_users(spark):
    schemas = spark.createDataFrame(
        [
            (1, "score", "numeric", "pending_create", "db_pending"),
            (2, "email", "varchar", "pending_create", "db_pending"),
            (3, "nickname", "varchar", "create_completed", "migrate_pending"),
        ],
        "id long, name string, type string, db_status string, migrate_status string",
    )
    people = spark.createDataFrame([(1, "a")], "id long, email string")
    evolved = u.evolve_user_columns(people, schemas)
    assert evolved.columns == ["id", "email", "score"]
    assert evolved.schema["score"].dataType.simpleString() == "decimal(38,18)"
    created = u.columns_created(schemas)
    assert {tuple(r)[3:] for r in created.collect()} == {("create_completed", "migrate_pending")}
    done = u.promotion_done(created)
    assert {tuple(r)[3:] for r in done.collect()} == {("create_completed", "migrate_completed")}


def test_too_many_user_columns_are_refused(spark, monkeypatch):
    import pytest

    monkeypatch.setattr(u, "MAX_COLUMNS", 1)
    schemas = spark.createDataFrame(
        [(i, f"c{i}", "varchar", "pending_create", "db_pending") for i in range(3)],
        "id long, name string, type string, db_status string, migrate_status string",
    )
    with pytest.raises(ValueError):
        u.declared_columns(schemas, u.to_create())


def test_odd_column_names(spark):
    people = spark.createDataFrame([(1, None, "x"), (2, "b", None)], "id long, `utm.source` string, c string")
    props = spark.createDataFrame(
        [(1, "utm.source", "a", 1), (2, "utm.source", "c", 2), (3, "new.one", "n", 1)],
        "id long, name string, value string, user_id long",
    )
    found = u.consolidation(people, props, ["utm.source"]).collect()
    assert {(r["user_id"], r["action"], r["new_value"]) for r in found} == {(1, "fill", "a"), (2, "overwrite", "c")}
    after = u.consolidated_users(people, props)
    assert {tuple(r) for r in after.collect()} == {(1, "a", "x"), (2, "c", None)}
    promoted = u.promote_user_properties(people, props, {"new.one": "varchar", "utm.source": "varchar"})
    assert {tuple(r) for r in promoted.collect()} == {(1, "a", "x", "n"), (2, "c", None, None)}


def test_promotion_folds_case_and_keeps_unknown_users(spark):
    people = spark.createDataFrame([(1, "old"), (2, "kept")], "id long, email string")
    props = spark.createDataFrame(
        [(1, "Email", "new", 1), (2, "Email", "lost", 9)], "id long, name string, value string, user_id long"
    )
    found = u.promote_user_properties(people, props, {"Email": "varchar"})
    assert found.columns == ["id", "email"]
    assert sorted(found.collect()) == [(1, "new"), (2, "kept")]
    assert [r["id"] for r in u.unpromoted_properties(people, props, {"Email": "varchar"}).collect()] == [2]
