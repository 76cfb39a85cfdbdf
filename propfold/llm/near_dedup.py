"""Near duplicates by min-max hashing of word shingles.

Each permutation of the shingle hashes gives two signature values, the least and the
greatest hash under it, so a signature of ``BANDS * ROWS`` values takes half as many hash
evaluations. Bands of the signature name candidates; each candidate pair is confirmed on
the full shingle sets, and confirmed links are joined to components.

At similarity 0.8 a pair shares a band of five values with probability 0.33, and misses
all 36 with probability 6e-7.

No bucket is expanded into its pairs. Documents with equal sets are one candidate. In
each bucket the others are compared with one hub, chosen in ``HUBS`` ways over the bands;
most groups are joined by that. What is left of a bucket, members outside the component
that most of it is in, is compared with every member of other components in the bucket;
two members of one component need no comparison. Where that is many pairs, blocks of
members are compared inside tasks of bounded size, and only links leave them. So no link
between components is lost to a cap, and no pairs of a large group become rows.

Null and empty texts, and texts without words, have no shingles and are linked with
nothing. Texts of fewer words than a shingle have the whole sequence as their one
shingle. Rows that share a doc_id but not their text are documents of their own: each has
the component of its text, the id stands for both of them. Rows without doc_id take the
component of a row with an equal set; if there is none their component is null and they
are kept. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propfold.llm import texts
from propfold.llm.components import components
from propfold.llm.staging import stage

BANDS = 36
ROWS = 5
HUBS = 3
# Hubs of a bucket: the least id after its bits are flipped by the mask of the band.
HUB_MASKS = (0, 0x5555555555555555, 0x3333333333333333)
# Buckets with more pairs left are compared in blocks of so many asking and held members.
PAIRS = 64
OUTSIDE = 256
MEMBERS = 2048
PERCENT = 80
SIZE = 5

_FLIP = texts.numbers(11, BANDS * ROWS // 2)
_SPREAD = texts.numbers(12, BANDS * ROWS // 2) | np.uint64(1)


def shingle_sets(chunk: texts.Chunk, size: int) -> list[np.ndarray]:
    """Distinct shingle hashes of each row, ascending."""
    found = texts.words(chunk)
    hashes = texts.word_hashes(chunk, found, lower=True)
    keys, at = texts.windows(hashes, found.first, size)
    bounds = np.searchsorted(at, found.first, side="left")
    out = []
    for row in range(chunk.rows):
        a, b = bounds[row], bounds[row + 1]
        if b > a:
            out.append(np.unique(keys[a:b]))
            continue
        own = hashes[found.first[row] : found.first[row + 1]]
        one = texts.windows(own, np.array([0, len(own)]), len(own))[0] if len(own) else own
        out.append(one)
    return out


def signatures(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Least and greatest hash of each set under each permutation, side by side."""
    out = np.empty((len(first), 2 * len(_FLIP)), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k, (flip, spread) in enumerate(zip(_FLIP, _SPREAD, strict=True)):
            v = (values ^ flip) * spread
            out[:, 2 * k] = np.minimum.reduceat(v, first)
            out[:, 2 * k + 1] = np.maximum.reduceat(v, first)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    out = np.empty((len(signature), BANDS), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for band in range(BANDS):
            key = np.full(len(signature), band + 1, dtype=np.uint64)
            for k in range(ROWS):
                key = texts.mixed(key * np.uint64(0xA0761D6478BD642F) + signature[:, band * ROWS + k])
            out[:, band] = key
    return out


def described(batch: pa.RecordBatch, size: int) -> pa.RecordBatch:
    counts, prints, bands, full = [], [], [], []
    for chunk in texts.chunks(batch.column("text")):
        sets = shingle_sets(chunk, size)
        n = np.array([len(s) for s in sets], dtype=np.int64)
        print_ = np.zeros((len(n), 2), dtype=np.uint64)
        some = np.flatnonzero(n)
        if len(some):
            values = np.concatenate([sets[k] for k in some])
            first = np.concatenate([[0], np.cumsum(n[some])[:-1]])
            with np.errstate(over="ignore"):
                for k, seed in enumerate(texts.numbers(13, 2)):
                    print_[some, k] = np.add.reduceat(texts.mixed(values ^ seed), first)
            bands.append(band_keys(signatures(values, first)))
        counts.append(n)
        prints.append(print_)
        full.append(n > 0)
    n = np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)
    prints = np.concatenate(prints) if prints else np.zeros((0, 2), dtype=np.uint64)
    flat = np.concatenate(bands).ravel() if bands else np.zeros(0, dtype=np.uint64)
    return pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"),
            pa.array(n),
            pa.array(prints[:, 0].astype(np.int64)),
            pa.array(prints[:, 1].astype(np.int64)),
            texts.row_lists(flat.view(np.int64), (n > 0) * BANDS, pa.int64()),
        ],
        names=["doc_id", "n_shingles", "print1", "print2", "bands"],
    )


def describe(documents: DataFrame, size: int) -> DataFrame:
    """Size, fingerprint and band keys of the shingle set of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield described(batch, size)

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shape = "doc_id long, n_shingles long, print1 long, print2 long, bands array<long>"
    return rows.mapInArrow(run, shape)


def confirmed(batch: pa.RecordBatch, size: int, percent: int) -> pa.RecordBatch:
    """The pairs of a batch that are similar enough on their full sets.

    Rows of one a mostly come in runs; its set is then made once.
    """
    first, second = batch.column("a").to_numpy(), batch.column("b").to_numpy()
    fresh = np.ones(len(first), dtype=bool)
    fresh[1:] = first[1:] != first[:-1]
    run = np.cumsum(fresh) - 1
    column = batch.column("a_text").take(pa.array(np.flatnonzero(fresh)))
    heads = [s for chunk in texts.chunks(column) for s in shingle_sets(chunk, size)]
    others = (s for chunk in texts.chunks(batch.column("b_text")) for s in shingle_sets(chunk, size))
    keep = []
    for row, other in enumerate(others):
        one = heads[run[row]]
        small, large = (one, other) if len(one) <= len(other) else (other, one)
        if not len(small) or 100 * len(small) < percent * len(large):
            continue
        at = np.searchsorted(large, small)
        shared = int((large[np.minimum(at, len(large) - 1)] == small).sum())
        if 100 * shared >= percent * (len(one) + len(other) - shared):
            keep.append(row)
    return pa.RecordBatch.from_arrays([pa.array(first[keep]), pa.array(second[keep])], names=["a", "b"])


def confirm(pairs: DataFrame, documents: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) of doc_ids whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield confirmed(batch, size, percent)

    held = documents.select(F.col("doc_id").cast("long").alias("id"), "text").where("id is not null")
    b = held.select(F.col("id").alias("b"), F.col("text").alias("b_text"))
    a = held.select(F.col("id").alias("a"), F.col("text").alias("a_text"))
    both = pairs.select("a", "b").join(b, "b").join(a, "a").select("a", "b", "a_text", "b_text")
    return both.mapInArrow(run, "a long, b long")


def near_duplicates(documents: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of each row.

    ``component_id`` is the smallest doc_id that confirmed links reach, ``kept`` marks the
    document it belongs to.
    """
    rows = stage(describe(documents, size), "shingle-sets")
    classes = stage(
        rows.where("n_shingles > 0 and doc_id is not null")
        .groupBy("print1", "print2")
        .agg(
            F.min("doc_id").alias("id"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
        ),
        "shingle-classes",
    )
    mask = F.element_at(F.array(*(F.lit(m) for m in HUB_MASKS)), F.col("band") % HUBS + 1)
    members = classes.select("id", F.posexplode("bands").alias("band", "key")).select(
        "id", "key", mask.alias("mask")
    )
    buckets = (
        members.groupBy("key", "mask")
        .agg(F.min(F.col("id").bitwiseXOR(F.col("mask"))).alias("hub"), F.count("*").alias("size"))
        .where("size > 1")
        .select("key", F.col("hub").bitwiseXOR(F.col("mask")).alias("hub"))
    )
    shared = stage(members.select("id", "key").join(buckets, "key"), "shared-buckets")
    sizes = classes.select("id", "n")
    star = stage(
        fitting(shared.where("id <> hub").select(F.col("hub").alias("a"), F.col("id").alias("b")), sizes, percent),
        "hub-pairs",
    )
    links = stage(confirm(star, documents, size, percent), "links")
    split = stage(split_buckets(shared, components(links)), "split-buckets")
    rest = fitting(few_apart(split), sizes, percent).join(star, ["a", "b"], "left_anti")
    links = links.union(confirm(stage(rest, "left-apart"), documents, size, percent))
    links = links.union(many_apart(split, documents, size, percent))
    found = components(links)
    labelled = classes.select("print1", "print2", "id").join(found, "id", "left").select(
        "print1", "print2", F.coalesce("component", "id").alias("component")
    )
    return (
        rows.select("doc_id", "n_shingles", "print1", "print2")
        .join(labelled, ["print1", "print2"], "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def fitting(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs, smaller id first, whose set sizes allow the similarity."""
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    a = sizes.select(F.col("id").alias("a"), F.col("n").alias("a_n"))
    b = sizes.select(F.col("id").alias("b"), F.col("n").alias("b_n"))
    return (
        pairs.join(a, "a")
        .join(b, "b")
        .where(100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))
        .select("a", "b")
    )


def split_buckets(shared: DataFrame, found: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component, with its id.

    ``main`` is the component that holds most of the bucket, ``outside`` the number of
    members that are not in it, ``size`` the number of all.
    """
    members = shared.select("id", "key").join(found, "id", "left").select(
        "id", "key", F.coalesce("component", "id").alias("component")
    )
    parts = members.groupBy("key", "component").agg(F.count("*").alias("n"))
    split = (
        parts.groupBy("key")
        .agg(
            F.max(F.struct("n", "component")).alias("main"),
            F.count("*").alias("parts"),
            F.sum("n").alias("size"),
        )
        .where("parts > 1")
        .select("key", F.col("main.component").alias("main"), "size", (F.col("size") - F.col("main.n")).alias("outside"))
    )
    return members.join(split, "key")


def few_apart(split: DataFrame) -> DataFrame:
    """Pairs in different components, of buckets that have at most ``PAIRS`` of them.

    One side is outside the main component; the other is any member.
    """
    members = split.where(F.col("outside") * F.col("size") <= PAIRS)
    outside = members.where("component <> main").select(
        F.col("id").alias("a"), "key", F.col("component").alias("a_component")
    )
    other = members.select(F.col("id").alias("b"), "key", F.col("component").alias("b_component"))
    return outside.join(other, "key").where("a_component <> b_component").select("a", "b")


def many_apart(split: DataFrame, documents: DataFrame, size: int, percent: int) -> DataFrame:
    """Links between components in the buckets that ``few_apart`` leaves out.

    Members outside the main component are dealt to blocks of about ``OUTSIDE``, all
    members to blocks of about ``MEMBERS``; a task compares one block with another and
    gives at most one link for two components, so no pair becomes a row.
    """
    members = split.where(F.col("outside") * F.col("size") > PAIRS).select(
        "key",
        "id",
        "component",
        (F.col("component") != F.col("main")).alias("asks"),
        F.ceil(F.col("outside") / OUTSIDE).cast("int").alias("rows"),
        F.ceil(F.col("size") / MEMBERS).cast("int").alias("columns"),
    )
    own = F.xxhash64("key", "id")
    held = members.select(
        "key",
        "id",
        "component",
        F.lit(False).alias("asks"),
        F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row"),
        F.pmod(own, F.col("columns")).cast("int").alias("column"),
    )
    asking = members.where("asks").select(
        "key",
        "id",
        "component",
        "asks",
        F.pmod(own, F.col("rows")).cast("int").alias("row"),
        F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("column"),
    )
    texts_ = documents.select(F.col("doc_id").cast("long").alias("id"), "text").where("id is not null")
    blocks = held.union(asking).join(texts_, "id")

    def run(block: pa.Table) -> pa.Table:
        return block_links(block.combine_chunks(), size, percent)

    return blocks.groupBy("key", "row", "column").applyInArrow(run, "a long, b long")


def block_links(block: pa.Table, size: int, percent: int) -> pa.Table:
    """A link for each two components of a block that one is found for.

    The sets of the asking members are held as lists of owners by shingle; the sets of
    the others pass by one at a time.
    """
    ids, component = block.column("id").to_numpy(), block.column("component").to_numpy()
    asks = block.column("asks").to_numpy(zero_copy_only=False).astype(bool)
    text = block.column("text").combine_chunks()
    text = pa.concat_arrays(text.chunks) if isinstance(text, pa.ChunkedArray) else text

    def sets(rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        places = iter(rows.tolist())
        for chunk in texts.chunks(text.take(pa.array(rows))):
            for one in shingle_sets(chunk, size):
                yield next(places), one

    asking = list(sets(np.flatnonzero(asks)))
    n = np.array([len(s) for _, s in asking], dtype=np.int64)
    rows = np.array([row for row, _ in asking], dtype=np.int64)
    shingles = np.concatenate([s for _, s in asking]) if asking else np.zeros(0, np.uint64)
    order = np.argsort(shingles, kind="stable")
    owner = np.repeat(np.arange(len(n)), n)[order]
    shingles = shingles[order]
    found: dict[tuple[int, int], tuple[int, int]] = {}
    for row, one in sets(np.flatnonzero(~asks)):
        first = np.searchsorted(shingles, one, side="left")
        counts = np.searchsorted(shingles, one, side="right") - first
        at = np.arange(counts.sum()) + np.repeat(first - (np.cumsum(counts) - counts), counts)
        shared = np.bincount(owner[at], minlength=len(n))
        near = 100 * shared >= percent * (n + len(one) - shared)
        near &= (component[rows] != component[row]) & (n > 0)
        for k in np.flatnonzero(near).tolist():
            pair = int(component[rows[k]]), int(component[row])
            found.setdefault((min(pair), max(pair)), (int(ids[rows[k]]), int(ids[row])))
    links = list(found.values())
    return pa.table(
        {"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())}
    )
