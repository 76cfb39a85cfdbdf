"""Language of texts by a bidirectional gated recurrent network over bytes.

A text is read as UTF-8 bytes in windows of ``WINDOW`` bytes, whole, each window in both
directions by a network of ``HIDDEN`` gated units a direction. Every byte gets a
probability for each language from the two states at its place; those of all bytes of a
text are averaged, and the language with the greatest average is the prediction (the
first in alphabetic order, if several are equal).

The network is trained on the driver, in numpy, by backpropagation through time and Adam,
on a bounded sample: at most ``FIT_ROWS`` labelled rows over at most ``LANGUAGES``
languages (the most frequent ones, equally many rows of each), and ``FIT_WINDOWS``
windows of each row. All three are parameters. Rows are drawn by a hash, so a run that is
repeated learns the same; repeated rows are learnt from once. Scoring covers every byte
of every text, in tasks, without a shuffle; the weights go out by broadcast, and their
size depends on the parameters alone.

A null text, and one without any letter, is ``und`` with score 0. Rows without a language
or without a ``doc_id`` are not learnt from, but are predicted. With one language learnt,
that is predicted throughout with score 1; with none, all texts are ``und``. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from propfold.llm import texts

WINDOW = 64
HIDDEN = 12
FIT_ROWS = 2400
FIT_WINDOWS = 4
LANGUAGES = 64
EPOCHS = 6
BATCH = 128
RATE = 0.02
SEED = 11
UNKNOWN = "und"

PAD = 256  # stands behind the end of a text: it holds the state
GROUP = 2048  # windows scored at once


class Model(NamedTuple):
    """Weights; the three gates (update, reset, new) are stacked in the first dimension."""

    langs: tuple[str, ...]
    inputs: np.ndarray  # 2 directions, 3 gates of units, 257 bytes
    states: np.ndarray  # 2 directions, 3 gates of units, units
    output: np.ndarray  # languages, 2 times units
    bias: np.ndarray  # languages


class Trace(NamedTuple):
    """What the way back through time needs of each step."""

    before: np.ndarray
    update: np.ndarray
    reset: np.ndarray
    carried: np.ndarray
    new: np.ndarray


def sigmoid(x: np.ndarray) -> np.ndarray:
    """In place; by tanh, which numpy computes faster than the exponential's quotient."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1.0
    x *= 0.5
    return x


def order(direction: int, steps: int) -> range:
    return range(steps) if direction == 0 else range(steps - 1, -1, -1)


def read(inputs: np.ndarray, states: np.ndarray, codes: np.ndarray, direction: int, trace: list[Trace] | None = None) -> np.ndarray:
    """States of one direction at each place: (steps, units, windows); ``codes`` is (steps, windows)."""
    steps, count = codes.shape
    units = states.shape[1]
    out = np.empty((steps, units, count), dtype=inputs.dtype)
    h = np.zeros((units, count), dtype=inputs.dtype)
    for t in order(direction, steps):
        x, u = inputs[:, codes[t]], states @ h
        gates = sigmoid(x[: 2 * units] + u[: 2 * units])
        update, reset = gates[:units], gates[units:]
        carried = u[2 * units :]
        new = np.tanh(x[2 * units :] + reset * carried)
        after = h - new
        after *= update
        after += new
        if trace is not None:
            trace.append(Trace(h, update, reset, carried, new))
        out[t] = h = after
    return out


def probabilities(model: Model, forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    """(languages, windows) at one place."""
    units = forward.shape[0]
    x = model.output[:, :units] @ forward
    x += model.output[:, units:] @ backward
    x += model.bias[:, None]
    x -= x.max(axis=0)
    np.exp(x, out=x)
    x /= x.sum(axis=0)
    return x


# Training


def gradients(model: Model, codes: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross-entropy over all bytes, by backpropagation through time."""
    steps, count = codes.shape
    units = model.states.shape[2]
    traces: list[list[Trace]] = [[], []]
    states = [read(model.inputs[d], model.states[d], codes, d, traces[d]) for d in (0, 1)]
    wanted = np.arange(len(model.langs))[:, None] == label
    real = codes != PAD
    total = max(int(real.sum()), 1)
    d_output, d_bias = np.zeros_like(model.output), np.zeros_like(model.bias)
    d_states_out = [np.empty_like(s) for s in states]
    for t in range(steps):
        error = (probabilities(model, states[0][t], states[1][t]) - wanted) * (real[t] / total)
        error = error.astype(model.output.dtype)
        d_output[:, :units] += error @ states[0][t].T
        d_output[:, units:] += error @ states[1][t].T
        d_bias += error.sum(axis=1)
        back = model.output.T @ error
        d_states_out[0][t], d_states_out[1][t] = back[:units], back[units:]
    d_inputs, d_states = np.zeros_like(model.inputs), np.zeros_like(model.states)
    for d in (0, 1):
        passed = np.zeros((units, count), dtype=model.states.dtype)
        at_gates = np.empty((steps, 3 * units, count), dtype=model.states.dtype)
        for t, step in zip(reversed(order(d, steps)), reversed(traces[d]), strict=True):
            dh = passed + d_states_out[d][t]
            d_new = dh * (1 - step.update) * (1 - step.new**2)
            d_update = dh * (step.before - step.new) * step.update * (1 - step.update)
            d_reset = d_new * step.carried * step.reset * (1 - step.reset)
            through = np.concatenate([d_update, d_reset, d_new * step.reset])
            at_gates[t] = np.concatenate([d_update, d_reset, d_new])
            d_states[d] += through @ step.before.T
            passed = dh * step.update + model.states[d].T @ through
        flat, byte = at_gates.transpose(0, 2, 1).reshape(-1, 3 * units), codes.ravel()
        by = np.argsort(byte, kind="stable")
        first = np.flatnonzero(np.diff(byte[by], prepend=-1))
        d_inputs[d][:, byte[by][first]] = np.add.reduceat(flat[by], first).T
    d_inputs[:, :, PAD] = 0
    return [d_inputs, d_states, d_output, d_bias]


def start(langs: tuple[str, ...], units: int, seed: int) -> Model:
    random = np.random.default_rng(seed)

    def drawn(*shape: int, scale: float) -> np.ndarray:
        return random.normal(0, scale, shape).astype(np.float32)

    inputs = drawn(2, 3 * units, PAD + 1, scale=0.3)
    inputs[:, :, PAD] = 0
    inputs[:, :units, PAD] = 30  # the update gate is shut: the state stays as it is
    return Model(
        langs,
        inputs,
        drawn(2, 3 * units, units, scale=units**-0.5),
        drawn(len(langs), 2 * units, scale=units**-0.5),
        np.zeros(len(langs), dtype=np.float32),
    )


def train(
    codes: np.ndarray, label: np.ndarray, langs: tuple[str, ...], units: int = HIDDEN, epochs: int = EPOCHS, seed: int = SEED
) -> Model:
    """Adam over shuffled batches of windows (``codes`` is (windows, steps)); the rate falls to 0."""
    model, random = start(langs, units, seed), np.random.default_rng(seed)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in model[1:]]
    total, done = epochs * -(-len(codes) // BATCH), 0
    for _ in range(epochs):
        mixed = random.permutation(len(codes))
        for at in range(0, len(mixed), BATCH):
            chosen = mixed[at : at + BATCH]
            slopes = gradients(model, np.ascontiguousarray(codes[chosen].T), label[chosen])
            done += 1
            rate = RATE * (1 - (done - 1) / total)
            for weight, slope, (mean, square) in zip(model[1:], slopes, moments, strict=True):
                mean += 0.1 * (slope - mean)
                square += 0.01 * (slope * slope - square)
                weight -= rate * (mean / (1 - 0.9**done)) / (np.sqrt(square / (1 - 0.99**done)) + 1e-8)
    return model


def window_codes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """(windows, width): bytes from each begin on, padded from each end on."""
    at = begins[:, None] + np.arange(width)
    inside = at < ends[:, None]
    return np.where(inside, data[np.minimum(at, len(data) - 1)].astype(np.intp), PAD)


def drawn_windows(text: str = "text", rows: int = FIT_WINDOWS) -> Column:
    """Windows of a text as binaries, at places given by a hash of the row."""
    data = F.col(text).cast("binary")
    room = F.greatest(F.octet_length(data) - WINDOW + 1, F.lit(1))
    places = [F.pmod(F.xxhash64("doc_id", F.lit(k)), room.cast("long")) + 1 for k in range(rows)]
    return F.array(*(F.substring(data, place.cast("int"), F.lit(WINDOW)) for place in places))


def fit(documents: DataFrame, fit_rows: int = FIT_ROWS, languages: int = LANGUAGES) -> Model:
    """Learn from ``text`` and ``lang`` of documents whose ``lang`` is not null."""
    usable = documents.where("doc_id is not null and lang is not null and octet_length(text) > 0")
    usable = usable.select("doc_id", F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = usable.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(languages).collect()
    langs = tuple(sorted(row["lang"] for row in counts))
    if len(langs) < 2:
        return start(langs, HIDDEN, SEED)
    quota = max(fit_rows // len(langs), 1)
    # Twice the quota by chance, then exactly the quota: what is sorted does not grow.
    share = F.lit(0.0)
    for row in counts:
        share = F.when(F.col("lang") == row["lang"], min(1.0, (2 * quota + 50) / row["count"])).otherwise(share)
    draw = F.xxhash64(F.lit(SEED), "doc_id", F.octet_length("text"))
    chosen = (
        usable.withColumn("draw", draw)
        .where(F.pmod("draw", F.lit(1 << 30)) < share * (1 << 30))
        .groupBy("lang", "draw")
        .agg(F.min(drawn_windows()).alias("windows"))
    )
    bound = len(langs) * (3 * quota + 200)
    found: dict[str, list] = {lang: [] for lang in langs}
    for row in chosen.orderBy("draw", "lang").limit(bound).toLocalIterator():
        if len(found[row["lang"]]) < quota:
            found[row["lang"]].append(row["windows"])
    data, label = [], []
    for place, lang in enumerate(langs):
        for windows in found[lang]:
            data += [bytes(w) for w in windows]
            label += [place] * len(windows)
    lengths = np.array([len(w) for w in data])
    ends = np.cumsum(lengths)
    codes = window_codes(np.frombuffer(b"".join(data), np.uint8), ends - lengths, ends)
    return train(codes, np.array(label), langs)


# Scoring


def window_probabilities(model: Model, codes: np.ndarray) -> Iterator[np.ndarray]:
    """Probabilities at each place: (languages, windows) for one step after the other."""
    forward = read(model.inputs[0], model.states[0], codes, 0)
    backward = read(model.inputs[1], model.states[1], codes, 1)
    for t in range(len(codes)):
        yield probabilities(model, forward[t], backward[t])


def chunk_windows(chunk: texts.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and row of each window of the texts of a chunk."""
    lengths = np.diff(chunk.offsets)
    count = -(-lengths // WINDOW)
    row = np.repeat(np.arange(chunk.rows), count)
    place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    return chunk.offsets[row] + place * WINDOW, chunk.offsets[row + 1], row


def pooled(model: Model, column: pa.Array) -> np.ndarray:
    """Mean probabilities over all bytes of each text: (texts, languages); 0 for empty texts."""
    out = np.zeros((len(column), len(model.langs)))
    for chunk in texts.chunks(column):
        begins, ends, row = chunk_windows(chunk)
        sums = np.zeros((len(model.langs), chunk.rows))
        for at in range(0, len(row), GROUP):
            some = slice(at, at + GROUP)
            codes = np.ascontiguousarray(window_codes(chunk.data, begins[some], ends[some]).T)
            total = np.zeros((len(model.langs), codes.shape[1]))
            for code, p in zip(codes, window_probabilities(model, codes), strict=True):
                total += p * (code != PAD)
            for k in range(len(sums)):
                sums[k] += np.bincount(row[some], total[k], chunk.rows)
        lengths = np.maximum(np.diff(chunk.offsets), 1)
        out[chunk.first : chunk.first + chunk.rows] = (sums / lengths).T
    return out


def predict(documents: DataFrame, model: Model, columns: list[str] | None = None) -> DataFrame:
    """The given columns (by default ``doc_id``) as the struct ``document``, ``lang_pred``
    and ``score``, the mean probability of that language."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    text = F.col("text").cast("string")
    rows = documents.select(
        F.struct(*(["doc_id"] if columns is None else columns)).alias("document"),
        F.coalesce(text, F.lit("")).alias("text"),
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        langs = np.array([*model.langs, UNKNOWN], dtype=object)
        for batch in batches:
            lettered = batch.column("lettered").to_numpy(zero_copy_only=False)
            score, best = np.zeros(batch.num_rows), np.full(batch.num_rows, len(model.langs))
            if len(model.langs) == 1:
                best[lettered], score[lettered] = 0, 1.0
            elif model.langs:
                p = pooled(model, batch.column("text"))
                best[lettered] = p.argmax(axis=1)[lettered]
                score[lettered] = p.max(axis=1)[lettered]
            yield pa.RecordBatch.from_arrays(
                [batch.column("document"), pa.array(langs[best], pa.string()), pa.array(np.minimum(score, 1.0))],
                names=["document", "lang_pred", "score"],
            )

    shape = StructType([rows.schema["document"], *StructType.fromDDL("lang_pred string, score double")])
    return rows.mapInArrow(run, shape)


def spans(documents: DataFrame, model: Model) -> DataFrame:
    """Where each language is spoken: ``document`` (``doc_id``) and runs of bytes whose label
    is the same, as an array of (begin, end, lang). Needs at least two languages."""
    sent = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(
        F.struct("doc_id").alias("document"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    shape = StructType(
        [
            rows.schema["document"],
            *StructType.fromDDL("spans array<struct<begin: long, end: long, lang: string>>"),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
        for batch in batches:
            out = []
            for chunk in texts.chunks(batch.column("text")):
                begins, ends, _ = chunk_windows(chunk)
                label = np.empty(len(chunk.data), dtype=np.int32)
                for at in range(0, len(begins), GROUP):
                    some = slice(at, at + GROUP)
                    codes = np.ascontiguousarray(window_codes(chunk.data, begins[some], ends[some]).T)
                    for t, p in enumerate(window_probabilities(model, codes)):
                        real = codes[t] != PAD
                        label[begins[some][real] + t] = p.argmax(axis=0)[real]
                for low, high in zip(chunk.offsets[:-1], chunk.offsets[1:], strict=True):
                    part = label[low:high]
                    cut = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
                    out.append(
                        [
                            {"begin": int(a), "end": int(b), "lang": model.langs[part[a]]}
                            for a, b in zip(cut[:-1], cut[1:], strict=True)
                        ]
                    )
            yield pa.RecordBatch.from_arrays([batch.column("document"), pa.array(out, kind)], names=["document", "spans"])

    return rows.mapInArrow(run, shape)


def held_out(doc_id: Column) -> Column:
    """Rows kept out of the fit: the CRC-32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
