"""Seen ids against Python sets, and how often a row meets an island."""

import random

from pyspark.sql import functions as F

from propfold.plans import queries
from propfold.sources import given, seen


def some_ids(pick):
    """Ids alone, in short runs, in runs longer than a word and a block, and below zero."""
    ids = set(range(-200, -60)) | set(range(65_530, 65_540)) | set(range(131_072, 270_000))
    ids |= set(range(300_000, 302_000)) | {2**40, -(2**40)}
    for _ in range(400):
        first = pick.randrange(400_000, 440_000)
        ids |= set(range(first, first + pick.randint(1, 150)))
    return ids | set(range(500_000, 520_000, 3))


def as_islands(ids):
    found = []
    for i in sorted(ids):
        if found and i == found[-1][2] + 1 and i >> seen.BLOCK_BITS == found[-1][0]:
            found[-1][2] = i
        else:
            found.append([i >> seen.BLOCK_BITS, i, i])
    return {tuple(f) for f in found}


def test_islands_and_unseen_rows_against_sets(spark):
    pick = random.Random(3)
    ids = some_ids(pick)
    given_ids = [(i,) for i in [*ids, *pick.sample(sorted(ids), 500)]] + [(None,)]
    stored = seen.islands(spark.createDataFrame(given_ids, "id long")).cache()
    assert stored.dtypes == [("block", "bigint"), ("first", "bigint"), ("last", "bigint")]
    rows = [tuple(r) for r in stored.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == as_islands(ids)

    probes = [*range(-300, 0), *range(60_000, 70_000), *range(131_000, 310_000), *range(399_000, 530_000)]
    probes += [2**40, 2**40 + 1, -(2**40), 7, 7, 65_530]
    table = spark.createDataFrame([(i,) for i in [*probes, None]], "id long")
    new = sorted(i for i in probes if i not in ids)
    for ranges in (None, [], [(300_000, 301_999)]):
        assert sorted(r["id"] for r in seen.unseen(table, stored, ranges=ranges).collect()) == new, ranges
    stored.unpersist()


def test_a_row_meets_few_islands(spark):
    # Every other id is seen: 32,768 islands in one block.
    ids = spark.range(0, 1 << seen.BLOCK_BITS, 2)
    words = seen.island_words(seen.islands(ids))
    per_key = words.groupBy("_word").count().agg(F.max("count"), F.count("*")).first()
    assert tuple(per_key) == (1, 1 << seen.BLOCK_BITS - seen.WORD_BITS)


def test_the_query_stores_its_islands(spark, tmp_path, monkeypatch):
    events = spark.range(1, 40).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-02 10:00:00' as ts", "id as user_id",
        "'purchase' as event_type", "id * 1.5D as value", "concat('{k:', id, '}') as props",
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    for name in ("orders", "documents"):
        spark.createDataFrame([], given.GIVEN[name]).write.parquet(str(tmp_path / f"{name}.parquet"))
    met = []

    def noted(rows, islands, *args, unseen=seen.unseen):
        met.append(islands)
        return unseen(rows, islands, *args)

    monkeypatch.setattr(seen, "unseen", noted)
    found = queries.registered()["unseen_properties"](spark, str(tmp_path))
    assert met[0].inputFiles() and not any("events.parquet" in f for f in met[0].inputFiles())
    whole = given.event_properties(spark, str(tmp_path))
    wanted = whole.where("event_id % 3 <> 0")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
