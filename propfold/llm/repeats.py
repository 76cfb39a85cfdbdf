"""Repeated passages by deep-shallow suffix sorting.

A byte is repeated if a string of ``SIZE`` bytes that covers it starts at another place
as well, in the same text or another one; strings do not cross texts. Texts are taken as
UTF-8 bytes, whole.

The suffixes that have to be sorted are found first. Each string of ``SIZE`` bytes has an
anchor, its leftmost ``GRAM``-byte piece of least hash, so equal strings have equal
anchors at equal places. Strings of a text that start one after the other and share an
anchor form a run of some 85 starts on average. Anchors that occur once are dropped by a
count, and runs with equal contexts (all bytes of their strings) are taken once, with
their number.

If all runs of an anchor have one context, all their strings are repeated. Otherwise the
suffixes at all starts of the distinct contexts are sorted: multikey quicksort on
eight-byte characters to a depth of ``SHALLOW`` bytes, then each bucket that is still
together is ordered by a blind trie, which looks only at the bytes where members branch.
Strings that agree for ``SIZE`` bytes end in one leaf. Groups are sorted inside tasks that
hold one key range each; an anchor of more than ``GROUP`` contexts is not gathered at all:
its strings are counted by their hash with map-side combining.

Null and empty texts have no bytes. Repeated rows are repeats of each other. Columns
other than doc_id and text are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from propfold.llm import texts
from propfold.llm.staging import stage

SIZE = 200
GRAM = 32  # a power of two
SHALLOW = 32
# Contexts of an anchor that are sorted in one task; more are counted by hash.
GROUP = 30_000
# Suffixes compared at once by blind tries.
BATCH = 200_000
PIECE = 1 << 20

_TABLE = texts.numbers(21, 256)
_STEPS = texts.numbers(22, 16) | np.uint64(1)
_PLACE = np.uint64((1 << 21) - 1)


def pieces(column: pa.Array, size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Bytes of whole rows, or of parts of a long one, with the starts they answer for.

    Gives data, row, place of the first byte in its row, begin and end in data, for each
    part. Parts of a row overlap by ``size - 1`` bytes, so each start is in one of them.
    """
    parts, held = [], 0

    def packed():
        data = np.concatenate([p[0] for p in parts])
        ends = np.cumsum([len(p[0]) for p in parts])
        row, place = (np.array([p[k] for p in parts], dtype=np.int64) for k in (1, 2))
        return data, row, place, ends - [len(p[0]) for p in parts], ends

    for chunk in texts.chunks(column, PIECE):
        for k in range(chunk.rows):
            a, b = chunk.offsets[k], chunk.offsets[k + 1]
            for begin in range(a, b - size + 1, PIECE // 2):
                data = chunk.data[begin : min(b, begin + PIECE // 2 + size - 1)]
                if held + len(data) > PIECE:
                    yield packed()
                    parts, held = [], 0
                parts.append((data, chunk.first + k, begin - a))
                held += len(data)
    if parts:
        yield packed()


def runs(data: np.ndarray, begin: np.ndarray, end: np.ndarray, size: int):
    """Part, first and last start, and anchor hash of each run of strings."""
    with np.errstate(over="ignore"):
        h, width, step = _TABLE[data], 1, 0
        while width < GRAM:
            h = h[:-width] * _STEPS[step] + h[width:]
            width, step = 2 * width, step + 1
        h = texts.mixed(h)
    key = (h & ~_PLACE) | np.arange(len(h), dtype=np.uint64)
    span, width, least = size - GRAM + 1, 1, key
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < span:
        gap = span - width
        least = np.minimum(least[:-gap], least[gap:])
    counts = end - begin - size + 1
    part = np.repeat(np.arange(len(begin)), counts)
    first = np.cumsum(counts) - counts
    start = np.arange(counts.sum()) - np.repeat(first, counts) + np.repeat(begin, counts)
    anchor = (least[start] & _PLACE).astype(np.int64)
    new = np.ones(len(start), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(start)) - 1
    return part[at], start[at], start[last], h[anchor[at]]


def anchors(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    for data, _, _, begin, end in pieces(batch.column("text"), size):
        found = runs(data, begin, end, size)[3]
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["anchor"])


def occurrences(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Runs of the texts: anchor, hash of the context, text, first and last start."""
    up, down = texts.powers(PIECE + 1)
    for data, row, place, begin, end in pieces(batch.column("text"), size):
        part, first, last, found = runs(data, begin, end, size)
        with np.errstate(over="ignore"):
            total = np.zeros(len(data) + 1, dtype=np.uint64)
            np.cumsum(texts.BYTES[data] * up[: len(data)], out=total[1:])
            context = (total[last + size] - total[first]) * down[first]
            context = texts.mixed(context + (last - first).astype(np.uint64))
        shift = place[part] - begin[part]
        take = pa.array(row[part])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(found.view(np.int64)),
                pa.array(context.view(np.int64)),
                batch.column("key1").take(take),
                batch.column("key2").take(take),
                pa.array((first + shift).astype(np.int32)),
                pa.array((last + shift).astype(np.int32)),
            ],
            names=["anchor", "context", "key1", "key2", "first", "last"],
        )


def sort_groups(buffer: np.ndarray, at: np.ndarray, group: np.ndarray, size: int) -> np.ndarray:
    """Which of the suffixes agree for ``size`` bytes with another one of their group.

    ``at`` are places in ``buffer``, ``group`` their groups, ascending.
    """
    repeated = np.zeros(len(at), dtype=bool)
    view = np.lib.stride_tricks.sliding_window_view(np.append(buffer, np.zeros(8, np.uint8)), 8)

    live, bucket = np.arange(len(at)), group
    for depth in range(0, SHALLOW, 8):  # multikey quicksort, a character is eight bytes
        character = view[at[live] + depth].reshape(-1, 8).copy().view(">u8").ravel().astype(np.uint64)
        order, bucket = together(bucket, character)
        live = live[order]
    cuts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(live) else []
    begin = 0
    while begin < len(live):  # whole buckets, about BATCH suffixes at once
        after = np.searchsorted(cuts, begin + BATCH, side="left")
        end = int(cuts[after]) if after < len(cuts) else len(live)
        own = live[begin:end]
        repeated[own] = blind_tries(buffer, at[own], bucket[begin:end], size)
        begin = end
    return repeated


def together(bucket: np.ndarray, character: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members of buckets of two or more after a split by a further character.

    Gives their order and their new buckets, ascending.
    """
    order = np.lexsort((character, bucket))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (bucket[order][1:] != bucket[order][:-1]) | (character[order][1:] != character[order][:-1])
    label = np.cumsum(new) - 1
    keep = np.bincount(label)[label] > 1 if len(label) else new
    return order[keep], label[keep]


def blind_tries(buffer: np.ndarray, at: np.ndarray, bucket: np.ndarray, size: int) -> np.ndarray:
    """Which suffixes end in a leaf of two or more; members of a bucket agree so far.

    A node is the first place at which members of a bucket differ from its first member;
    the bytes before it are skipped. All buckets go on by one node at a time.
    """
    repeated = np.zeros(len(at), dtype=bool)
    live = np.arange(len(at))
    width = size - SHALLOW
    padded = -(-width // 8) * 8
    tail = np.zeros((len(live), padded), dtype=np.uint8)
    rows = np.lib.stride_tricks.sliding_window_view(buffer, width)
    tail[:, :width] = rows[at[live] + SHALLOW]
    tail = tail.view(">u8").astype(np.uint64)
    member = np.arange(len(live))
    while len(member):  # blind tries, all groups by one branching node at a time
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        sizes = np.diff(np.append(first, len(member)))
        differs = tail[member] != np.repeat(tail[member[first]], sizes, axis=0)
        branch = np.where(differs.any(axis=1), differs.argmax(axis=1), padded // 8)
        node = np.minimum.reduceat(branch, first)
        same = np.repeat(node == padded // 8, sizes)
        repeated[live[member[same]]] = True
        node = np.repeat(node, sizes)[~same]
        member, bucket = member[~same], bucket[~same]
        order, bucket = together(bucket, tail[member, node])
        member = member[order]
    return repeated


def sorted_contexts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Runs of repeated starts of each context; rows of an anchor follow one another."""

    def solved(table: pa.Table) -> pa.RecordBatch:
        bytes_ = table.column("bytes").combine_chunks()
        if isinstance(bytes_, pa.ChunkedArray):
            bytes_ = pa.concat_arrays(bytes_.chunks)
        chunk = next(texts.chunks(bytes_, 1 << 62))
        counts = np.diff(chunk.offsets) - size + 1
        row = np.repeat(np.arange(chunk.rows), counts)
        start = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        anchor = table.column("anchor").to_numpy()
        group = np.cumsum(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        flag = sort_groups(chunk.data, chunk.offsets[row] + start, group[row], size)
        begins = flag.copy()
        begins[1:] &= ~(flag[:-1] & (row[1:] == row[:-1]))
        ends = flag.copy()
        ends[:-1] &= ~(flag[1:] & (row[1:] == row[:-1]))
        a, b = np.flatnonzero(begins), np.flatnonzero(ends)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(anchor[row[a]]),
                pa.array(table.column("context").to_numpy()[row[a]]),
                pa.array(start[a]),
                pa.array(start[b]),
            ],
            names=["anchor", "context", "from", "to"],
        )

    held: list[pa.Table] = []
    starts = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        starts += int(sum(len(x) for x in batch.column("bytes").to_pylist())) // 3
        if starts < BATCH:
            continue
        table = pa.concat_tables(held)
        anchor = table.column("anchor").to_numpy()
        cut = int(np.searchsorted(anchor, anchor[-1], side="left"))  # the last may go on
        bounds = np.flatnonzero(np.concatenate([[True], anchor[1:cut] != anchor[: cut - 1], [True]])) if cut else []
        begin = 0
        for end in bounds[1:]:
            if end - begin >= BATCH // 100 or end == cut:
                yield solved(table.slice(begin, end - begin))
                begin = end
        held, starts = [table.slice(cut)], 0
    if held:
        table = pa.concat_tables(held)
        if table.num_rows:
            anchor = table.column("anchor").to_numpy()
            begin = 0
            for end in np.append(np.flatnonzero(anchor[1:] != anchor[:-1]) + 1, table.num_rows):
                if end - begin >= BATCH // 100 or end == table.num_rows:
                    yield solved(table.slice(begin, end - begin))
                    begin = end


def keyed(documents: DataFrame) -> DataFrame:
    """Rows with two numbers that tell texts apart: 128 bits of the text if there is no doc_id, else the id and 64."""
    return documents.select(
        "doc_id",
        "text",
        *keys(),
    )


def keys() -> list[Column]:
    return [
        F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.lit(1), "text")).alias("key1"),
        F.xxhash64("text").alias("key2"),
    ]


def repeated_spans(documents: DataFrame, size: int = SIZE) -> DataFrame:
    """(key1, key2, spans) of the texts of ``keyed`` that hold repeated strings.

    ``spans`` are (from, to) of maximal runs of strings, in bytes, each once, not merged.
    """
    rows = keyed(documents).select("key1", "key2", "text")

    def over(kernel):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield from kernel(batch, size)

        return run

    often = rows.select("text").mapInArrow(over(anchors), "anchor long")
    often = often.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    shape = "anchor long, context long, key1 long, key2 long, first int, last int"
    found = rows.mapInArrow(over(occurrences), shape)
    found = stage(found.join(often, "anchor", "left_semi"), "runs")

    distinct = found.groupBy("anchor", "context").agg(
        F.count("*").alias("n"),
        *(F.first(c).alias(c) for c in ("key1", "key2", "first", "last")),
    )
    distinct = stage(distinct, "contexts")
    width = distinct.groupBy("anchor").agg(F.count("*").alias("contexts"))
    several = width.where("contexts > 1")
    whole = distinct.where("n > 1").select(
        "anchor", "context", F.lit(0).alias("from"), (F.col("last") - F.col("first")).alias("to")
    )
    # Rows that share both keys hold one text; it is taken once, however many they are.
    one = rows.where("text is not null").groupBy("key1", "key2").agg(F.first("text").cast("binary").alias("text"))
    contexts = (
        distinct.join(several, "anchor")
        .join(one, ["key1", "key2"])
        .select(
            "anchor",
            "context",
            "contexts",
            F.col("text").substr(F.col("first") + 1, F.col("last") - F.col("first") + size).alias("bytes"),
        )
    )
    few = contexts.where(F.col("contexts") <= GROUP)
    few = few.repartition("anchor").sortWithinPartitions("anchor", "context")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from sorted_contexts(batches, size)

    shape = "anchor long, context long, from long, to long"
    solved = few.select("anchor", "context", "bytes").mapInArrow(run, shape)
    solved = solved.withColumns({c: F.col(c).cast("int") for c in ("from", "to")})
    strings = contexts.where(F.col("contexts") > GROUP).select(
        "anchor",
        "context",
        "bytes",
        F.explode(F.sequence(F.lit(0), F.length("bytes") - size)).alias("from"),
    )
    strings = strings.select(
        "anchor", "context", "from", F.col("bytes").substr(F.col("from") + 1, F.lit(size)).alias("string")
    ).select("anchor", "context", "from", F.xxhash64("string").alias("s1"), F.xxhash64(F.lit(1), "string").alias("s2"))
    twice = strings.groupBy("anchor", "s1", "s2").agg(F.count("*").alias("n")).where("n > 1")
    counted = strings.join(twice, ["anchor", "s1", "s2"], "left_semi").select(
        "anchor", "context", "from", F.col("from").alias("to")
    )
    repeated = whole.union(solved).union(counted)
    spans = found.join(repeated, ["anchor", "context"]).select(
        "key1",
        "key2",
        (F.col("first") + F.col("from")).alias("from"),
        (F.col("first") + F.col("to") + size).alias("to"),
    )
    return spans.groupBy("key1", "key2").agg(F.collect_set(F.struct("from", "to")).alias("spans"))


def merged(spans: np.ndarray) -> np.ndarray:
    """Spans (from, to) as maximal runs that neither meet nor overlap, ascending."""
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.ones(len(spans), dtype=bool)
    new[1:] = spans[1:, 0] > reach[:-1]
    first = np.flatnonzero(new)
    return np.stack([spans[first, 0], reach[np.append(first[1:], len(spans)) - 1]], axis=1)


def row_spans(column: pa.Array) -> Iterator[np.ndarray | None]:
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    both = np.stack([flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1)], axis=1).astype(np.int64)
    end = 0
    for n in lengths:
        yield merged(both[end : end + n]) if n else None
        end += n


def without(text: bytes, spans: np.ndarray) -> bytes:
    return b"".join(
        text[a:b] for a, b in zip([0, *spans[:, 1]], [*spans[:, 0], len(text)], strict=True)
    )


def with_spans(documents: DataFrame, size: int) -> DataFrame:
    """Rows of ``keyed`` with their spans, null where there are none."""
    spans = repeated_spans(documents, size)
    return keyed(documents).join(spans, ["key1", "key2"], "left").select("doc_id", "text", "spans")


def each_text(texts_: pa.Array, spans: pa.ListArray) -> Iterator[tuple[bytes, np.ndarray | None]]:
    for text, own in zip(texts_.cast(pa.binary()), row_spans(spans), strict=True):
        yield text.as_py() or b"", own


def repeat_digest(documents: DataFrame, size: int = SIZE) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers, digests = [], []
            for text, spans in each_text(batch.column("text"), batch.column("spans")):
                kept = text if spans is None else without(text, spans)
                numbers.append((len(text), len(text) - len(kept), 0 if spans is None else len(spans)))
                digests.append(hashlib.sha256(kept).hexdigest())
            numbers = np.array(numbers, dtype=np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(numbers[:, k]) for k in range(3)), pa.array(digests, pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    kind = documents.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return with_spans(documents, size).mapInArrow(run, shape)


def whole_characters(text: bytes, spans: np.ndarray) -> np.ndarray:
    """Spans drawn in so that no character of the text is cut."""
    data = np.frombuffer(text, dtype=np.uint8)
    out = []
    for a, b in spans.tolist():
        while a < b and a < len(data) and data[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if b > a:
            out.append((a, b))
    return np.array(out, dtype=np.int64).reshape(-1, 2)


def unused(name: str, columns: list[str]) -> str:
    """The name, lengthened until no column has it."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def without_repeats(documents: DataFrame, size: int = SIZE) -> DataFrame:
    """All rows and columns, with repeated passages taken out of text.

    Characters of which a passage holds only some bytes stay. A column n_chars, if there
    is one, is set anew for texts that change.
    """
    names = documents.columns
    key1, key2, found, altered = (unused(n, names) for n in ("key1", "key2", "spans", "altered"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, changed = [], []
            for text, spans in each_text(batch.column("text"), batch.column(found)):
                spans = None if spans is None else whole_characters(text, spans)
                changed.append(spans is not None)
                out.append(None if spans is None else without(text, spans).decode("utf-8", "replace"))
            fields = {n: batch.column(n) for n in names}
            flags = pa.array(changed, pa.bool_())
            fields["text"] = pc.if_else(flags, pa.array(out, pa.string()), fields["text"])
            yield pa.RecordBatch.from_arrays([*fields.values(), flags], names=[*names, altered])

    rows = documents.withColumns(dict(zip((key1, key2), keys(), strict=True)))
    rows = rows.join(repeated_spans(documents, size).toDF(key1, key2, found), [key1, key2], "left")
    shape = StructType([*documents.schema.fields, StructField(altered, BooleanType())])
    out = rows.select(*names, found).mapInArrow(run, shape)
    if "n_chars" in names:
        length = F.length("text").cast(documents.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col(altered), length).otherwise(F.col("n_chars")))
    return out.select(*names)
