"""Nearest neighbours by a permutation index.

``PIVOTS`` vectors are chosen as pivots (a bounded sample: those first by the hash of
their id). Each vector is represented by its ``LENGTH`` nearest pivots in order. Its
nearest pivot is its cell. Cells are put together, in the order of a walk over near pivots,
to shards of about ``SHARD`` rows, and a larger cell is split into several; within a shard
every vector is posted in the inverted file of each of its pivots, with the place the pivot
has. A query goes to the shards of the cells of its own nearest pivots only. There it reads
the files of its own pivots, which adds up Spearman's footrule between both orders (a pivot
that one side lacks has place ``LENGTH``). The ``SHARE`` of the shard that is nearest by
footrule, ``AT_LEAST`` rows if that is more, is ranked again by Euclidean distance in
double precision, and the nearest of all shards are merged.

How many cells a query visits is measured, not guessed: for at most ``SAMPLE`` queries
(those first by the hash of their id) the true neighbours are found by one pass over all
vectors, and so many cells are visited that ``TARGET`` of these neighbours lie in them.
Vectors that form groups need few cells; vectors without any structure need many.

Queries are put into blocks of at most about ``QUERIES`` by their own cell, and a shard
goes only to the blocks that ask for it, so a task holds one shard and one block, and the
rows moved grow with the shards that are visited. Every row is indexed; recall against
brute force is a test.

Null ids, null vectors, zero vectors, and vectors that hold null, NaN or infinite
components take no part, nor do vectors of another dimension than most have (the smaller
one at a tie). Rows that share a vec_id are one vector, the least distance counts; ties
go to the smaller vec_id. Fewer rows than asked for give as many results as there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from propfold.llm.staging import stage

PIVOTS = 256
LENGTH = 64
SHARD = 8192
QUERIES = 1024
SHARE = 0.2
AT_LEAST = 200
SAMPLE = 64
TARGET = 0.97


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, vector) of the rows that take part, as arrays of doubles."""
    vector = F.transform("embedding", lambda x: x.cast("double"))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    rows = rows.where("vec_id is not null and vector is not null")
    rows = rows.where(F.coalesce(finite, F.lit(False)) & F.exists("vector", lambda x: x != 0))
    most = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("vector") == (most["d"] if most else 0))


def choose_pivots(vectors: DataFrame) -> np.ndarray:
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOTS).collect()
    return np.unique(np.array([r["vector"] for r in rows], dtype=np.float64), axis=0)


def matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def orders(vectors: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """The nearest pivots of each vector, nearest first, ties to the smaller number."""
    far = (pivots**2).sum(axis=1)[None, :] - 2 * vectors @ pivots.T
    return np.argsort(far, axis=1, kind="stable")[:, :length].astype(np.int16)


def index(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, cell, vector, nearest) with both arrays as bytes."""
    length = min(LENGTH, len(pivots))
    sent = vectors.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column("vector"))
            near = orders(x, sent.value, length)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    pa.array(near[:, 0], pa.int32()),
                    pa.array([row.tobytes() for row in x], pa.binary()),
                    pa.array([row.tobytes() for row in near], pa.binary()),
                ],
                names=["vec_id", "cell", "vector", "nearest"],
            )

    return vectors.mapInArrow(run, "vec_id long, cell int, vector binary, nearest binary")


def vectors_of(column) -> np.ndarray:
    return np.stack([np.frombuffer(v) for v in column])


def true_neighbours(rows: DataFrame, ids: np.ndarray, asked: np.ndarray, k: int) -> DataFrame:
    """(query, cell): the cells of the ``k`` nearest rows of each of a few vectors, by brute force."""
    sent = rows.sparkSession.sparkContext.broadcast((ids, asked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, queries = sent.value
        best: list[list[tuple]] = [[] for _ in own]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = vectors_of(batch.column("vector").to_pylist())
            vec_id = batch.column("vec_id").to_numpy()
            cell = batch.column("cell").to_numpy()
            far = (x**2).sum(axis=1)[None, :] - 2 * queries @ x.T
            far[own[:, None] == vec_id[None, :]] = np.inf
            for query, row in enumerate(far):
                at = np.argpartition(row, k)[:k] if k < len(row) else np.arange(len(row))
                found = [(float(row[i]), int(vec_id[i]), int(cell[i])) for i in at if row[i] < np.inf]
                best[query] = sorted(best[query] + found)[:k]
        flat = [(query, *entry) for query, entries in enumerate(best) for entry in entries]
        columns = list(zip(*flat, strict=True)) or [(), (), (), ()]
        kinds = [pa.int32(), pa.float64(), pa.int64(), pa.int32()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["query", "far", "vec_id", "cell"]
        )

    found = rows.mapInArrow(run, "query int, far double, vec_id long, cell int")
    order = Window.partitionBy("query").orderBy("far", "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).select("query", "cell")


def cells_to_visit(rows: DataFrame, asked: DataFrame, pivots: np.ndarray, k: int, target: float) -> int:
    """How many cells hold the ``target`` of the true neighbours of a sample of queries."""
    sample = asked.orderBy(F.xxhash64(F.lit(7), "vec_id"), "vec_id").limit(SAMPLE).collect()
    if not sample:
        return 1
    x = vectors_of([r["vector"] for r in sample])
    order = orders(x, pivots, len(pivots))
    ids = np.array([r["vec_id"] for r in sample])
    near = true_neighbours(rows, ids, x, k).collect()  # at most SAMPLE times k rows
    places = sorted(int(np.flatnonzero(order[r["query"]] == r["cell"])[0]) for r in near)
    return places[int(np.ceil(target * len(places))) - 1] + 1 if places else 1


def walk(pivots: np.ndarray) -> list[int]:
    """The pivots in an order in which each is followed by the nearest that is left."""
    left, order = set(range(1, len(pivots))), [0]
    while left:
        rest = sorted(left)
        far = ((pivots[rest] - pivots[order[-1]]) ** 2).sum(axis=1)
        order.append(rest[int(far.argmin())])
        left.remove(order[-1])
    return order


def portions(sizes: dict[int, int], order: list[int], most: int) -> list[tuple[int, int]]:
    """For each cell its first portion and how many it has, of about ``most`` rows each.

    Small cells that follow each other share a portion; a large one is split by id.
    """
    found, portion, held = [(0, 1)] * len(order), -1, most
    for cell in order:
        size = sizes.get(cell, 0)
        if held + size > most:
            portion, held = portion + 1, 0
        parts = max(1, -(-size // most))
        found[cell] = (portion, parts)
        portion += parts - 1
        held = most if parts > 1 else held + size
    return found


def in_portion(found: list[tuple[int, int]], cell: Column, number: Column) -> Column:
    """Number of the portion that a row of the cell is dealt to."""
    first = F.array(*(F.lit(first) for first, _ in found))[cell]
    parts = F.array(*(F.lit(parts) for _, parts in found))[cell]
    return (first + F.pmod(number, parts)).cast("int")


def visits(asked: DataFrame, pivots: np.ndarray, cells: int, found: list[tuple[int, int]]) -> DataFrame:
    """(vec_id, shard): the shards that hold the cells of the first pivots of each query."""
    sent = asked.sparkSession.sparkContext.broadcast((pivots, found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, where = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            near = orders(vectors_of(batch.column("vector").to_pylist()), chosen, cells)
            shards = []
            for row in near:
                spans = (where[cell] for cell in row)
                shards.append(sorted({first + part for first, parts in spans for part in range(parts)}))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(shards, pa.list_(pa.int32()))], names=["vec_id", "shards"]
            )

    listed = asked.select("vec_id", "vector").mapInArrow(run, "vec_id long, shards array<int>")
    return listed.select("vec_id", F.explode("shards").alias("shard"))


class InvertedFiles:
    """The files of one shard: for each pivot the vectors that have it, and its place."""

    def __init__(self, nearest: np.ndarray):
        rows, self.length = nearest.shape
        flat = nearest.ravel()
        order = np.argsort(flat, kind="stable")
        self.rows = rows
        self.row, self.place = order // self.length, order % self.length
        self.first = np.searchsorted(flat[order], np.arange(flat.max(initial=0) + 2))

    def footrule(self, nearest: np.ndarray) -> np.ndarray:
        """Footrule of each vector to a query, less a constant."""
        total = np.zeros(self.rows, dtype=np.int64)
        for place, pivot in enumerate(nearest):
            if pivot + 1 >= len(self.first):
                continue
            at = slice(self.first[pivot], self.first[pivot + 1])
            there = self.place[at]
            # a vector has a pivot once at most, so no row repeats within a file
            total[self.row[at]] += np.abs(there - place) + there + place - 2 * self.length
        return total


def searched(key, held: pd.DataFrame, asked: pd.DataFrame, k: int, share: float) -> pd.DataFrame:
    held = held.sort_values("vec_id", kind="stable")
    ids = held["vec_id"].to_numpy()
    out = []
    if len(ids) and len(asked):
        x = np.stack([np.frombuffer(v) for v in held["vector"]])
        near = np.stack([np.frombuffer(v, dtype=np.int16) for v in held["nearest"]])
        files = InvertedFiles(near)
        n = min(len(ids), max(AT_LEAST, int(np.ceil(share * len(ids)))))
        for query, vector, nearest in zip(asked["vec_id"], asked["vector"], asked["nearest"], strict=True):
            rank = files.footrule(np.frombuffer(nearest, dtype=np.int16)) * len(ids) + np.arange(len(ids))
            rank[ids == query] = np.iinfo(np.int64).max
            best = np.argpartition(rank, n - 1)[:n]
            best = np.sort(best[ids[best] != query])
            far = np.sqrt(((x[best] - np.frombuffer(vector)) ** 2).sum(axis=1))
            by_id = np.lexsort((far, ids[best]))  # of rows that share an id, the least distance
            one = by_id[np.unique(ids[best][by_id], return_index=True)[1]]
            order = one[np.lexsort((ids[best][one], far[one]))[:k]]
            out.append(pd.DataFrame({"query_id": query, "vec_id": ids[best][order], "score": far[order]}))
    empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    return pd.concat(out) if out else empty


def planned(
    rows: DataFrame, is_query: Column, pivots: np.ndarray, k: int, target: float, shard: int, queries: int
) -> tuple[DataFrame, DataFrame]:
    """Rows by shard, and queries by the shards they visit, both by block."""
    asked = rows.where(is_query).dropDuplicates(["vec_id"])
    cells = cells_to_visit(rows, asked, pivots, k, target)
    order = walk(pivots)
    sizes = dict(rows.groupBy("cell").count().collect())  # one row per pivot
    shards = portions(sizes, order, shard)
    blocks = portions(dict(asked.groupBy("cell").count().collect()), order, queries)
    asked = asked.withColumn("block", in_portion(blocks, F.col("cell"), F.xxhash64(F.lit(3), "vec_id")))
    asked = stage(asked.join(visits(asked, pivots, cells, shards), "vec_id"), "permutation-queries")
    held = rows.withColumn("shard", in_portion(shards, F.col("cell"), F.xxhash64("vec_id")))
    wanted = asked.select("shard", F.col("block").alias("_block")).distinct()
    return held.join(wanted, "shard").withColumnRenamed("_block", "block"), asked


def nearest(
    embeddings: DataFrame,
    is_query: Column,
    k: int = 10,
    share: float = SHARE,
    target: float = TARGET,
    shard: int = SHARD,
    queries: int = QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each query row."""
    vectors = usable(embeddings)
    pivots = choose_pivots(vectors)
    shape = "query_id long, vec_id long, score double"
    if not len(pivots):
        found = vectors.sparkSession.createDataFrame([], shape)
    else:
        rows = stage(index(vectors, pivots), "permutation-index")
        held, asked = planned(rows, is_query, pivots, k, target, shard, queries)
        found = (
            held.groupBy("shard", "block")
            .cogroup(asked.groupBy("shard", "block"))
            .applyInPandas(lambda key, a, b: searched(key, a, b, k, share), shape)
        )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
