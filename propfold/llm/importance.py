"""Importance resampling of raw text towards a target (hashed n-gram models, Gumbel top-k).

Words and pairs of neighbouring words (A-Z as a-z) are hashed to ``BUCKETS``. Two models
give each bucket a probability: one over all documents, one over target documents. The
log weight of a text is the mean log ratio of both over its n-grams, times ``TEMPER``
n-grams, so that long texts are not favoured for their length alone. Gumbel noise, drawn
from a hash of the id (of the text, where there is no id), is added, and the greatest
``share`` of all rows, rounded up, are kept: a draw without replacement in proportion to
the weights.

Raw counts cover every text, whole. The target is a bounded sample of labelled rows, the
``TARGET_ROWS`` first by the hash of their id.

Null and empty texts have no n-grams and a log weight of minus infinity, so they are kept
last, in the order of their noise. Repeated rows have equal weight and noise; of rows that
tie at the bound, those first in the staged table are kept, so that the number of kept rows
is exact. Without target rows both models are equal and all weights 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propfold.llm import texts
from propfold.llm.staging import stage

BUCKETS = 16384  # a power of two
TARGET_ROWS = 20_000
SMOOTH = 1.0
TEMPER = 60.0
SHARE = 0.86  # where there is no label to count
SEED = 7

_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)


def grams(chunk: texts.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each n-gram in the order of rows, and how many precede each row."""
    found = texts.words(chunk)
    h = texts.word_hashes(chunk, found, lower=True)
    pairs, at = texts.windows(h, found.first, 2)
    row = np.concatenate([found.row, found.row[at]])
    bucket = (texts.mixed(np.concatenate([h, pairs * _PAIR])) & np.uint64(BUCKETS - 1)).astype(np.int64)
    order = np.argsort(row, kind="stable")
    return bucket[order], np.searchsorted(row[order], np.arange(chunk.rows + 1))


def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts over all texts and over the target, one row per bucket and task."""
    raw, target = np.zeros(BUCKETS, dtype=np.int64), np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        chosen = batch.column("target").to_numpy(zero_copy_only=False).astype(bool)
        for chunk in texts.chunks(batch.column("text")):
            bucket, first = grams(chunk)
            raw += np.bincount(bucket, minlength=BUCKETS)
            own = np.repeat(chosen[chunk.first : chunk.first + chunk.rows], np.diff(first))
            target += np.bincount(bucket[own], minlength=BUCKETS)
    at = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array(at), pa.array(raw[at]), pa.array(target[at])], names=["bucket", "raw", "target"]
    )


def log_ratios(documents: DataFrame, target: DataFrame, target_rows: int = TARGET_ROWS) -> np.ndarray:
    """Log ratio of each bucket; ``target`` has the doc_id of target documents."""
    chosen = target.where("doc_id is not null").select(F.col("doc_id").alias("target_id")).distinct()
    chosen = chosen.orderBy(F.xxhash64("target_id"), "target_id").limit(target_rows)
    rows = documents.select("doc_id", "text").join(
        F.broadcast(chosen), F.col("doc_id") == F.col("target_id"), "left"
    )
    rows = rows.select("text", F.col("target_id").isNotNull().alias("target"))
    counts = rows.mapInArrow(counted, "bucket long, raw long, target long")
    counts = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, wanted = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in counts.collect():  # at most BUCKETS rows
        raw[row["bucket"]], wanted[row["bucket"]] = row["raw"], row["target"]
    if not wanted.sum():
        return np.zeros(BUCKETS)
    wanted, raw = ((x + SMOOTH) / (x.sum() + SMOOTH * BUCKETS) for x in (wanted, raw))
    return np.log(wanted) - np.log(raw)


def noise(seed: int) -> Column:
    """A number between 0 and 1 from a hash of the id, or of the text of a row without one."""
    key = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(seed), "text")).otherwise(
        F.xxhash64(F.lit(seed), "doc_id")
    )
    return (F.pmod(key, F.lit(1 << 52)) + 0.5) / float(1 << 52)


def log_weights(documents: DataFrame, ratios: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_grams, log_weight, noise) of each row."""
    sent = documents.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights, counts = [np.zeros(0)], [np.zeros(0, dtype=np.int64)]
            for chunk in texts.chunks(batch.column("text")):
                bucket, first = grams(chunk)
                n = np.diff(first)
                mean = texts.row_sums(sent.value[bucket], first) / np.maximum(n, 1)
                weights.append(np.where(n > 0, TEMPER * mean, -np.inf))
                counts.append(n)
            weights, counts = pa.array(np.concatenate(weights)), pa.array(np.concatenate(counts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), counts, weights, batch.column("noise")],
                names=["doc_id", "n_grams", "log_weight", "noise"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text", noise(seed).alias("noise")).mapInArrow(
        run, f"doc_id {kind}, n_grams long, log_weight double, noise double"
    )


def kth_largest(rows: DataFrame, column: str, k: int) -> float:
    """Exact k-th largest finite value, by histograms that narrow down; minus infinity if
    there are fewer finite values.

    Each pass counts at most 4,096 bins in Spark; the last reads at most 4,096 values.
    """
    rows = rows.where(F.abs(column) < float("inf"))
    n, low, high = rows.agg(F.count("*"), F.min(column), F.max(column)).first()
    if k > n or not n:
        return -math.inf
    left = k
    while True:
        part = rows.where(F.col(column).between(low, high))
        width = (high - low) / 4096
        if low == high or not width or low + width == low:
            return low
        if n <= 4096:
            return part.orderBy(F.desc(column)).limit(left).agg(F.min(column)).first()[0]
        place = F.least(F.floor((F.col(column) - low) / width), F.lit(4095))
        bins = part.groupBy(place.alias("bin")).agg(
            F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")
        )
        for row in sorted(bins.collect(), key=lambda r: -r["bin"]):
            if left <= row["n"]:
                n, low, high = row["n"], row["low"], row["high"]
                break
            left -= row["n"]


def target_share(labels: DataFrame) -> float:
    """The part of the labelled documents that is of the target, quality = 1; unlabelled tables: ``SHARE``."""
    known = labels.where("doc_id is not null and quality is not null")
    share = known.agg(F.avg((F.col("quality") == 1).cast("int"))).first()[0]
    return SHARE if share is None else share


def first_rows(rows: DataFrame, columns: list[str], k: int) -> Column:
    """Condition for the ``k`` rows greatest by the columns in order; the last has no ties."""
    if k <= 0:
        return F.lit(False)
    column, *rest = columns
    bound = kth_largest(rows, column, k)
    above, same = F.col(column) > F.lit(bound), F.col(column) == F.lit(bound)
    n_above, n_same = rows.agg(F.count_if(above), F.count_if(same)).first()
    if n_above + n_same <= k or not rest:
        return above | same
    return above | (same & first_rows(rows.where(same), rest, k - n_above))


def resample(documents: DataFrame, target: DataFrame, share: float = SHARE, seed: int = SEED) -> DataFrame:
    """(doc_id, n_grams, log_weight, draw, kept) of each row; no row is shuffled."""
    weights = log_weights(documents, log_ratios(documents, target), seed)
    draw = F.col("log_weight") - F.log(-F.log("noise"))
    # minus the place: of equal rows the first are the greatest
    place = -F.monotonically_increasing_id().cast("double")
    rows = stage(weights.withColumns({"draw": draw, "place": place}), "draws")
    kept = first_rows(rows, ["draw", "noise", "place"], math.ceil(share * rows.count()))
    return rows.withColumn("kept", kept).drop("noise", "place")
