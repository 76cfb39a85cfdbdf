"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the presence of its words, of pairs of neighbouring words and of
pairs with one word between, hashed to ``BITS`` bits; A-Z count as a-z. FTRL-proximal
keeps a learning rate for each coordinate and its L1 term holds most weights at exactly
zero, so the model is a short list of weights.

The fit takes at most ``FIT_ROWS`` labelled rows of each class, those first in the order
of a hash of their id; this bound is a parameter. The bias is corrected by the counts of
both classes over all labels. Scoring covers every text, whole.

A null or empty text has no features: its score is that of the bias alone. Labels that
are null are not learnt from; repeated rows are learnt from and scored as often as they
occur. With no labelled rows, or rows of one class only, all scores are 0 for class 0 or
no class, and 1 for class 1.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from propfold.llm import texts

BITS = 20
FIT_ROWS = 3000
EPOCHS = 6
ALPHA = 2.0
BETA = 1.0
L1 = 4.0
L2 = 0.0
THRESHOLD = 0.7

_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)
_SKIP = np.uint64(0x165667B19E3779F9)


class Model(NamedTuple):
    bias: float
    index: np.ndarray  # of the features with a weight, ascending
    weight: np.ndarray


def features(chunk: texts.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of each row, with repeats, and the row of each."""
    found = texts.words(chunk)
    h = texts.word_hashes(chunk, found, lower=True)
    row, shift = found.row, np.uint64(64 - BITS)
    out, rows = [h], [row]
    with np.errstate(over="ignore"):
        for gap, salt in ((1, _PAIR), (2, _SKIP)):
            same = row[gap:] == row[:-gap] if len(row) > gap else np.zeros(0, dtype=bool)
            out.append((h[:-gap][same] * salt + h[gap:][same]) * salt)
            rows.append(row[:-gap][same])
        return (texts.mixed(np.concatenate(out)) >> shift).astype(np.int64), np.concatenate(rows)


def sparse_rows(batch: pa.RecordBatch) -> pa.Array:
    """Distinct features of each text, as a list."""
    values, counts = [], []
    for chunk in texts.chunks(batch.column("text")):
        feature, row = features(chunk)
        pairs = np.unique(row << BITS | feature)
        values.append(pairs & ((1 << BITS) - 1))
        counts.append(np.bincount(pairs >> BITS, minlength=chunk.rows))
    if not counts:
        return texts.row_lists(np.zeros(0, np.int64), np.zeros(0, np.int64), pa.int32())
    return texts.row_lists(np.concatenate(values), np.concatenate(counts), pa.int32())


def ftrl(rows: Sequence[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> Model:
    """FTRL-proximal passes over the rows in the order given."""
    size = 1 << BITS
    z, n = np.zeros(size + 1), np.zeros(size + 1)
    l1 = np.full(size + 1, L1)
    l1[size] = 0.0

    def weights(at: np.ndarray) -> np.ndarray:
        zs, cut = z[at], l1[at]
        w = (np.sign(zs) * cut - zs) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        w[np.abs(zs) <= cut] = 0.0
        return w

    for _ in range(epochs):
        for row, y in zip(rows, labels, strict=True):
            at = np.append(row, size)  # the bias is the last coordinate
            w = weights(at)
            p = 1.0 / (1.0 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - y
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - sigma * w
            n[at] += g * g
    w = weights(np.arange(size + 1))
    index = np.flatnonzero(w[:size])
    return Model(float(w[size]), index, w[index])


def fit(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Learn from documents that have a label; ``labels`` has doc_id and toxic.

    Of each class the ``fit_rows`` rows first by the hash of their id are taken, so that
    one task and the driver hold a bounded number of feature lists.
    """
    marked = labels.where("doc_id is not null and toxic in (0, 1)").select(
        F.col("doc_id").alias("marked_id"), F.col("toxic").cast("int").alias("label")
    )
    order = [F.xxhash64(F.col("marked_id")), F.col("marked_id"), F.col("label")]
    chosen = marked.where("label = 0").orderBy(*order).limit(fit_rows)
    chosen = chosen.union(marked.where("label = 1").orderBy(*order).limit(fit_rows))
    rows = documents.select("doc_id", "text").join(
        F.broadcast(chosen), F.col("doc_id") == F.col("marked_id")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), sparse_rows(batch)],
                names=["doc_id", "label", "features"],
            )

    shape = "doc_id long, label int, features array<int>"
    found = rows.select("doc_id", "label", "text").mapInArrow(run, shape)
    table = found.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(2 * fit_rows).toArrow()
    labels_found = table.column("label").to_numpy().astype(np.float64)
    none = np.zeros(0, dtype=np.int64)
    if len(set(labels_found)) < 2:
        return Model(np.inf if labels_found.any() else -np.inf, none, none.astype(np.float64))
    # views of the Arrow buffers, not copies
    lists = [x.values.to_numpy() for chunk in table.column("features").chunks for x in chunk]
    model = ftrl(lists, labels_found)
    # The bounds may change how often a class occurs; the bias is set back for that.
    counts = {r["label"]: r["n"] for r in marked.groupBy("label").agg(F.count("*").alias("n")).collect()}
    odds = labels_found.sum() / (len(labels_found) - labels_found.sum())
    return model._replace(bias=model.bias + float(np.log(counts[1] / counts[0] / odds)))


def scored(batch: pa.RecordBatch, dense: np.ndarray, bias: float) -> np.ndarray:
    out = []
    for chunk in texts.chunks(batch.column("text")):
        feature, row = features(chunk)
        known = dense[feature] != 0
        pairs = np.unique(row[known] << BITS | feature[known])
        total = np.bincount(pairs >> BITS, dense[pairs & ((1 << BITS) - 1)], chunk.rows)
        out.append(1.0 / (1.0 + np.exp(-np.clip(total + bias, -500, 500))))
    return np.concatenate(out) if out else np.zeros(0)


def score(
    documents: DataFrame, model: Model, columns: list[str] | None = None, name: str = "score"
) -> DataFrame:
    """The given columns (by default doc_id) of each row, and a score from 0 to 1.

    The weights go out as one broadcast of at most ``2**BITS`` numbers. No shuffle.
    """
    columns = ["doc_id"] if columns is None else columns
    sent = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(*columns, *([] if "text" in columns else ["text"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bias, index, weight = sent.value
        dense = np.zeros(1 << BITS)
        dense[index] = weight
        for batch in batches:
            out = pa.array(scored(batch, dense, bias))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), out], names=[*columns, name]
            )

    shape = StructType([*(rows.schema[c] for c in columns), StructField(name, DoubleType())])
    return rows.mapInArrow(run, shape)


def held_out(doc_id: Column) -> Column:
    """Rows kept out of the fit: the CRC-32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))
