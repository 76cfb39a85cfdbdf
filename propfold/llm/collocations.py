"""Phrase collocations by stripes: each prefix keys a counter of the words that follow it.

A stripe is a language, a prefix (none to three words), and an associative counter from
next word to occurrences. Tasks count their texts into stripes and send them in compressed
blocks, by the hash of their prefix; stripes of one prefix are then merged elementwise, a
block's worth of prefixes at a time. All that is needed comes from the merged stripes: the
entries are the frequencies of the phrases and so the totals of longer prefixes, the sum of
the empty prefix is the number of words (rare ones are kept under the empty word), and the
greatest entries, from the right and, by dropping the first word, from the left, are what a
phrase may be subsumed by.

Most runs of words are rare, so three passes over the texts come first. Pass ``k`` adds up
the occurrences of runs of ``k`` words whose inner runs may be frequent, as four-byte
entries of a table of ``2**KEY_BITS`` counters that is dealt to ``GROUPS`` groups; a task
holds the counters of one group at a time, as many as there are entries for. Runs whose counter reaches ``LEAST`` are marked
in a Bloom filter of ``FILTER_BITS`` bits, the only thing that is broadcast and of fixed
size. A counter never falls short of a run's own count, so nothing frequent is left out; a
wrong mark costs some counting and changes no result. Only marked runs go into stripes.

The counter of the empty prefix, and those of prefixes that occur ``HOT`` times (marked in
filters as well), are split by the hash of the next word into parts, so that no group grows
with the texts.

Words are runs of bytes other than blank and tab within pieces, which end at
``[.,;:!?\\x0A-\\x0D]`` and at the end of a text; A-Z count as a-z. Only phrases of up to
four words that occur ``LEAST`` times in their language are candidates. A null language is
``und``. Null and empty texts have no words; repeated rows count as often as they occur.
An empty table gives no rows. All numbers are exact: products are taken as decimals.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from propfold.llm import texts
from propfold.llm.staging import stage

LEAST = 30
LONGEST = 4
SUBSUMED_PERCENT = 80
SCALE = 2_000_000
TOP = 2000

SLICE_BYTES = 6 << 20  # of text counted at once
KEY_BITS = 36  # of the table of counters
GROUP_BITS = 24  # of the counters of one group
GROUPS = 1 << (KEY_BITS - GROUP_BITS)
COUNT_BITS = 32
COUNT_MASK = (1 << COUNT_BITS) - 1
HELD = 1 << 19  # entries of a group or block that are held before they are added up
HELD_BYTES = 32 << 20  # of stripes that a task holds before it sends them
FILTER_BITS = 1 << 25
HOT_BITS = 1 << 20
FILTER_HASHES = 3
WORD_PARTS = 1024  # of the counter of the empty prefix
HOT = 10_000  # occurrences from which a counter is split
PARTS = 64  # of such a counter
LEAST_BLOCKS = 256
BLOCK_RUNS = 1 << 20  # frequent runs whose stripes are merged at once
TOP_PARTS = 64

UNKNOWN = "und"
STRIPE = "lang string, prefix string, size int, part int, words array<string>, counts array<long>"

BREAK = np.zeros(256, dtype=bool)
BREAK[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
# A-Z as a-z, and what ends a piece as a blank.
PLAIN = np.arange(256, dtype=np.uint8)
PLAIN[65:91] += 32
PLAIN[BREAK] = 0x20

KEYS = ["lang", "prefix", "size", "part"]
STRIPE_ARROW = pa.schema(
    [
        ("lang", pa.string()),
        ("prefix", pa.string()),
        ("size", pa.int32()),
        ("part", pa.int32()),
        ("words", pa.list_(pa.string())),
        ("counts", pa.list_(pa.int64())),
    ]
)


# Words of a slice


class Counted(NamedTuple):
    """The words of some texts in order: which one, of which language, and what follows."""

    vocabulary: pa.Array
    word: np.ndarray  # place in the vocabulary
    langs: pa.Array
    lang: np.ndarray  # place among the languages
    linked: np.ndarray  # the next word stands in the same piece


def places(values: pa.DictionaryArray) -> np.ndarray:
    return values.indices.to_numpy(zero_copy_only=False)


def counted(batch: pa.RecordBatch) -> Iterator[Counted]:
    """The words of a batch, some ``SLICE_BYTES`` of whole texts at once."""
    langs = batch.column("lang").dictionary_encode()
    lang_of = places(langs)
    for chunk in texts.chunks(batch.column("text"), SLICE_BYTES):
        plain = PLAIN[chunk.data]
        found = texts.words(chunk._replace(data=plain))
        offsets = np.zeros(len(found.starts) + 1, dtype=np.int32)
        np.cumsum(found.ends - found.starts, out=offsets[1:])
        letters = plain[~texts.SPACE[plain]]
        # from buffers: the bytes need not be valid UTF-8
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(letters)]
        words = pa.Array.from_buffers(pa.string(), len(found.starts), buffers).dictionary_encode()
        piece = np.concatenate((np.zeros(1, np.int32), np.cumsum(BREAK[chunk.data], dtype=np.int32)))[found.starts]
        linked = np.zeros(len(found.starts), dtype=bool)
        linked[:-1] = (piece[1:] == piece[:-1]) & (found.row[1:] == found.row[:-1])
        lang = lang_of[chunk.first : chunk.first + chunk.rows][found.row]
        yield Counted(words.dictionary, places(words), langs.dictionary, lang, linked)


# The filters of frequent runs


class Filter(NamedTuple):
    """Marks of runs of one length: those that may be frequent, and those with large counters."""

    frequent: np.ndarray
    hot: np.ndarray


def array_hashes(values: pa.Array) -> np.ndarray:
    """A 64-bit hash of the bytes of each value."""
    out = [np.zeros(0, dtype=np.uint64)]
    for chunk in texts.chunks(values):
        starts, ends = chunk.offsets[:-1], chunk.offsets[1:]
        found = texts.Words(starts, ends, np.arange(chunk.rows), np.arange(chunk.rows + 1))
        out.append(texts.word_hashes(chunk, found))
    return np.concatenate(out)


def chained(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return texts.mixed(left * np.uint64(0xA0761D6478BD642F) + right)


def keys_of(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - KEY_BITS)


def filter_places(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """The bits of each key in a filter of ``bits`` bits."""
    for k in range(FILTER_HASHES):
        yield (texts.mixed(keys * np.uint64(2 * k + 1) + np.uint64(k)) % np.uint64(bits)).astype(np.int64)


def marked(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    found, keys = np.ones(len(hashes), dtype=bool), keys_of(hashes)
    for bit in filter_places(keys, 8 * len(filter_)):
        found &= (filter_[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
    return found


class Runs(NamedTuple):
    """Linked runs of some words: where they begin, and their hashes."""

    at: np.ndarray
    hashes: np.ndarray


class Marks(NamedTuple):
    """For runs of one, two, ... words: where marked ones begin; some room behind."""

    begins: list[np.ndarray]
    next: Runs  # the runs one longer than the marked ones, of which both inner ones are marked


def marks_of(c: Counted, filters: list[Filter]) -> Marks:
    lang, word = array_hashes(c.langs), array_hashes(c.vocabulary)
    n, begins = len(c.word), []
    runs = Runs(np.arange(n), chained(lang[c.lang], word[c.word]))
    for length, filter_ in enumerate(filters, 1):
        on = marked(filter_.frequent, runs.hashes)
        at, hashes = runs.at[on], runs.hashes[on]
        mark = np.zeros(n + LONGEST, dtype=bool)
        mark[at] = True
        begins.append(mark)
        on = c.linked[at + length - 1] & mark[at + 1]
        at, hashes = at[on], hashes[on]
        runs = Runs(at, chained(hashes, word[c.word[at + length]]))
    return Marks(begins, runs)


def key_counts(c: Counted, filters: list[Filter]) -> pa.RecordBatch:
    """Occurrences of the runs one longer than the filters, as entries by group.

    An entry is a number of four bytes, the place in the group and below it up to 255
    occurrences; more occurrences are further entries.
    """
    keys = np.sort(keys_of(marks_of(c, filters).next.hashes)).astype(np.int64)
    at = runs_of(keys[1:] != keys[:-1], len(keys))
    keys, counts = keys[at[:-1]], np.diff(at)
    times = -(-counts // 255)
    last = np.cumsum(times) - 1
    each = np.full(int(times.sum()), 255)
    each[last] = counts - 255 * (times - 1)
    keys = np.repeat(keys, times)
    entries = ((keys & ((1 << GROUP_BITS) - 1)) << 8 | each).astype("<u4")
    group = keys >> GROUP_BITS
    at = runs_of(group[1:] != group[:-1], len(group))
    offsets = pa.py_buffer((at * 4).astype(np.int32))
    lists = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, offsets, pa.py_buffer(entries)])
    return pa.RecordBatch.from_arrays([pa.array(group[at[:-1]].astype(np.int32)), lists], names=["group", "entries"])


def added(held: list[np.ndarray]) -> np.ndarray:
    """Numbers of a place and, in the low ``COUNT_BITS`` bits, a count: counts by place."""
    entry = np.sort(np.concatenate(held))
    place = entry >> COUNT_BITS
    at = runs_of(place[1:] != place[:-1], len(place))[:-1]
    count = np.add.reduceat(entry & COUNT_MASK, at) if len(at) else entry
    # no overflow: both limits are far below
    return place[at] << COUNT_BITS | np.minimum(count, COUNT_MASK >> 1)


def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys whose counter reaches ``LEAST``, and whether it reaches ``HOT``; groups in order.

    What is held of a group is added up whenever it has doubled, so it stays within twice
    the counters of a group.
    """
    now, held, size, limit = -1, [], 0, HELD

    def found() -> pa.RecordBatch:
        entry = added(held)
        count = entry & COUNT_MASK
        key = (entry >> COUNT_BITS | now << GROUP_BITS)[count >= LEAST]
        hot = count[count >= LEAST] >= HOT
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(hot)], names=["key", "hot"])

    for batch in batches:
        for group, entries in zip(batch.column("group").to_pylist(), batch.column("entries"), strict=True):
            if group != now and held:
                yield found()
                held, size, limit = [], 0, HELD
            now = group
            entry = np.frombuffer(entries.as_buffer(), "<u4").astype(np.int64)
            held.append(entry >> 8 << COUNT_BITS | entry & 255)
            size += len(entry)
            if size > limit:
                held = [added(held)]
                size = len(held[0])
                limit = max(HELD, 2 * size)
    if held:
        yield found()


def bloom(keys: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter of the column ``key``, merged by its 64-bit words.

    The driver gets at most ``bits`` / 64 numbers, whatever there is to mark.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("key").to_numpy().astype(np.uint64)
            places = np.unique(np.concatenate(list(filter_places(key, bits))))
            yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64())], names=["bit"])

    one = F.expr("shiftleft(1L, cast(bit & 63 as int))")
    rows = keys.select("key").mapInArrow(run, "bit long").groupBy(F.shiftright("bit", 6).alias("at"))
    found = rows.agg(F.bit_or(one).alias("word")).toArrow()
    out = np.zeros(bits // 64, dtype=np.int64)
    out[found.column("at").to_numpy()] = found.column("word").to_numpy()
    return out.astype("<i8").view(np.uint8)


def run_filters(rows: DataFrame, filter_bits: int = FILTER_BITS) -> tuple[list[Filter], int]:
    """Filters of runs of one word up to one less than the longest, a pass over the texts
    each, and how many runs are marked."""
    filters: list[Filter] = []
    number = 0
    for length in range(1, LONGEST):
        sent = rows.sparkSession.sparkContext.broadcast(filters)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for words in counted(batch):
                    yield key_counts(words, sent.value)

        counts = rows.mapInArrow(run, "group int, entries binary")
        keys = counts.repartition("group").sortWithinPartitions("group").mapInArrow(reached, "key long, hot boolean")
        keys = stage(keys, f"runs-{length}")
        filters = [*filters, Filter(bloom(keys, filter_bits), bloom(keys.where("hot"), HOT_BITS))]
        number += keys.count()
    return filters, number


# Stripes


class Distinct(NamedTuple):
    """Distinct rows of some whole-number columns in order, and how often each occurs."""

    columns: list[np.ndarray]
    counts: np.ndarray


def runs_of(changed: np.ndarray, n: int) -> np.ndarray:
    """Where the runs of ``n`` rows begin, and the end; ``changed`` compares neighbours."""
    return np.concatenate(([0], np.flatnonzero(changed) + 1, [n])) if n else np.zeros(1, np.int64)


def distinct(columns: list[np.ndarray], ranges: list[int]) -> Distinct:
    """Rows packed into one number each, with ranks in between where that has no room."""
    key, span, tables = columns[0].astype(np.int64), ranges[0], {}
    for place in range(1, len(columns)):
        if span * ranges[place] >= 1 << 62:
            tables[place], key = np.unique(key, return_inverse=True)
            span = max(len(tables[place]), 1)
        key = key * np.int64(ranges[place]) + columns[place]
        span *= ranges[place]
    key.sort()
    at = runs_of(key[1:] != key[:-1], len(key))
    key, found = key[at[:-1]], []
    for place in range(len(columns) - 1, 0, -1):
        found.append(key % ranges[place])
        key = key // ranges[place]
        if place in tables:
            key = tables[place][key]
    return Distinct([key, *reversed(found)], np.diff(at))


def listed(found: Distinct, langs: pa.Array, words: pa.Array, parts: int, hot=None) -> pa.RecordBatch:
    """Distinct entries (language, prefix, next word) as stripes, in the order of their prefixes.

    The counters of prefixes that ``hot`` finds among prefix columns (all, by default) are
    dealt to parts by the hash of the next word; the others have one part.
    """
    *prefix, behind = found.columns
    n = len(behind)
    changed = np.zeros(max(n - 1, 0), dtype=bool)
    for column in prefix:
        changed |= column[1:] != column[:-1]
    runs = runs_of(changed, n)
    split = np.ones(len(runs) - 1, dtype=bool) if hot is None else hot([c[runs[:-1]] for c in prefix])
    run = np.repeat(np.arange(len(runs) - 1), np.diff(runs))
    part = np.zeros(n, dtype=np.int64)
    some = split[run]
    if some.any():
        part[some] = (array_hashes(words) % np.uint64(parts)).astype(np.int64)[behind[some]]
        order = np.lexsort((part, run))
        run, part, behind, counts = run[order], part[order], behind[order], found.counts[order]
    else:
        counts = found.counts
    at = runs_of((run[1:] != run[:-1]) | (part[1:] != part[:-1]), n)
    first = runs[:-1][run[at[:-1]]]
    spelt = [words.take(pa.array(column[first])) for column in prefix[1:]]
    if not spelt:
        prefixes = pa.array([""] * len(first), pa.string())
    else:
        prefixes = pc.binary_join_element_wise(*spelt, " ") if len(spelt) > 1 else spelt[0]
    keys = [langs.take(pa.array(prefix[0][first])), prefixes]
    keys += [pa.array(np.full(len(first), len(spelt), np.int32)), pa.array(part[at[:-1]].astype(np.int32))]
    return stripes_of_runs(keys, at, words.take(pa.array(behind)), counts)


def stripes_of_runs(keys: list[pa.Array], at: np.ndarray, words: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    """One row for each run of entries, which begin and end at ``at``."""
    offsets = pa.array(at.astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, x) for x in (words, pa.array(counts, pa.int64()))]
    return pa.RecordBatch.from_arrays([*keys, *lists], schema=STRIPE_ARROW)


def slice_stripes(c: Counted, filters: list[Filter]) -> Iterator[pa.RecordBatch]:
    """Counters of the empty prefix and of all marked ones.

    The word behind a prefix has an entry where the run that they make is marked (the last
    two runs in it, where no filter is as long); words that are not count under the empty one.
    """
    begins = marks_of(c, filters).begins
    # Only words that are marked are needed from here on.
    kept = np.unique(c.word[np.flatnonzero(begins[0][: len(c.word)])])
    nothing = len(kept)
    place = np.full(len(c.vocabulary), nothing, dtype=np.int64)
    place[kept] = np.arange(nothing)
    words = pa.concat_arrays([c.vocabulary.take(pa.array(kept)), pa.array([""], pa.string())])
    word = np.append(place[c.word], [nothing] * LONGEST)
    lang_hash, word_hash = array_hashes(c.langs), array_hashes(words)

    def hot(prefix: list[np.ndarray]) -> np.ndarray:
        hashes = lang_hash[prefix[0]]
        for column in prefix[1:]:
            hashes = chained(hashes, word_hash[column])
        return marked(filters[len(prefix) - 2].hot, hashes)

    n, langs = len(c.word), max(len(c.langs), 1)
    every = np.ones(n + LONGEST, dtype=bool)
    for size in range(LONGEST):
        at = np.flatnonzero((begins[size - 1] if size else every)[:n])
        if size < len(begins):
            on = begins[size][at]
        else:
            on = begins[-1][at] & begins[-1][at + 1] & c.linked[np.minimum(at + size - 1, n - 1)]
        behind = np.where(on, word[at + size], nothing)
        columns = [c.lang[at], *(word[at + k] for k in range(size)), behind]
        if size:  # what does not extend is needed of the empty prefix only
            columns = [column[on] for column in columns]
        found = distinct(columns, [langs, *[nothing + 1] * (size + 1)])
        parts = PARTS if size else WORD_PARTS
        yield listed(found, c.langs, words, parts, hot if size else None)


def merged(batch: pa.RecordBatch, whole: bool) -> pa.RecordBatch:
    """Stripes merged elementwise. In ``whole`` counters, rare words are left out; those of
    the empty prefix go under the empty word, which leaves its sum."""
    if not batch.num_rows:
        return batch
    ids = [places(batch.column(c).dictionary_encode()).astype(np.int64) for c in ("lang", "prefix")]
    ids.append(batch.column("part").to_numpy().astype(np.int64))
    key = ids[0]
    for column in ids[1:]:
        key = np.unique(key, return_inverse=True)[1] * (column.max() + 1) + column
    order = np.argsort(key, kind="stable")
    batch, key = batch.take(pa.array(order)), key[order]
    rows = runs_of(key[1:] != key[:-1], len(key))
    row_run = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    run = row_run[pc.list_parent_indices(batch.column("words")).to_numpy()]
    words = batch.column("words").flatten().dictionary_encode()
    span = np.int64(max(len(words.dictionary), 1))
    key = run * span + places(words)
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = runs_of(key[1:] != key[:-1], len(key))[:-1]
    counts = batch.column("counts").flatten().to_numpy()[order]
    counts = np.add.reduceat(counts, at) if len(at) else counts
    run, word, words = key[at] // span, key[at] % span, words.dictionary
    if whole:
        empty = pc.equal(words, "").to_numpy(zero_copy_only=False)
        rest = (counts < LEAST) | empty[word]
        total = np.zeros(len(rows) - 1, dtype=np.int64)
        np.add.at(total, run[rest], counts[rest])
        total[batch.column("size").to_numpy()[rows[:-1]] > 0] = 0
        more = np.flatnonzero(total)
        run = np.concatenate((run[~rest], more))
        order = np.argsort(run, kind="stable")
        word = np.concatenate((word[~rest], np.full(len(more), len(words))))[order]
        counts = np.concatenate((counts[~rest], total[more]))[order]
        words, run = pa.concat_arrays([words, pa.array([""], pa.string())]), run[order]
    at = runs_of(run[1:] != run[:-1], len(run))
    first = pa.array(rows[run[at[:-1]]])
    return stripes_of_runs([batch.column(c).take(first) for c in KEYS], at, words.take(pa.array(word)), counts)


def blocks(stripes: list[pa.RecordBatch], number: int, packer: zstandard.ZstdCompressor) -> pa.RecordBatch:
    """Stripes as compressed blocks, dealt by the hash of their prefix and part."""
    batch = merged(pa.concat_batches(stripes), whole=False)
    key = array_hashes(batch.column("lang"))
    key = chained(key, array_hashes(batch.column("prefix")))
    key = chained(key, batch.column("part").to_numpy().astype(np.uint64))
    block = (key % np.uint64(number)).astype(np.int64)
    order = np.argsort(block, kind="stable")
    batch, block = batch.take(pa.array(order)), block[order]
    at = runs_of(block[1:] != block[:-1], len(block))
    packed = [packer.compress(batch.slice(a, b - a).serialize()) for a, b in zip(at[:-1], at[1:], strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(block[at[:-1]].astype(np.int32)), pa.array(packed, pa.binary())], names=["block", "stripes"]
    )


def merged_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stripes of one block after the other, merged; what is held is merged whenever it
    has doubled."""
    unpacker = zstandard.ZstdDecompressor()
    now, held, size, limit = -1, [], 0, HELD
    for batch in batches:
        for block, packed in zip(batch.column("block").to_pylist(), batch.column("stripes"), strict=True):
            if block != now and held:
                yield merged(pa.concat_batches(held), whole=True)
                held, size, limit = [], 0, HELD
            now = block
            data = unpacker.decompress(packed.as_buffer())
            held.append(pa.ipc.read_record_batch(pa.py_buffer(data), STRIPE_ARROW))
            size += len(held[-1].column("words").flatten())
            if size > limit:
                held = [merged(pa.concat_batches(held), whole=False)]
                size = len(held[0].column("words").flatten())
                limit = max(HELD, 2 * size)
    if held:
        yield merged(pa.concat_batches(held), whole=True)


def entries(stripes: DataFrame) -> DataFrame:
    """Phrases that extend a prefix by one frequent word: ``lang``, ``phrase``, ``size``, ``a``."""
    pairs = stripes.select("lang", "prefix", "size", F.inline(F.arrays_zip("words", "counts")))
    phrase = F.when(F.col("size") == 0, F.col("words")).otherwise(F.concat_ws(" ", "prefix", "words"))
    return pairs.where("words <> ''").select(
        "lang", phrase.alias("phrase"), (F.col("size") + 1).alias("size"), F.col("counts").alias("a")
    )


def stripes_of(documents: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """The merged stripes of all prefixes of up to three words."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")
    rows = documents.select(lang, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    filters, number = run_filters(rows, filter_bits)
    dealt = max(LEAST_BLOCKS, -(-number // BLOCK_RUNS))
    sent = rows.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            held: list[pa.RecordBatch] = []
            for words in counted(batch):
                held += slice_stripes(words, sent.value)
                if sum(x.nbytes for x in held) > HELD_BYTES:
                    yield blocks(held, dealt, packer)
                    held = []
            if held:
                yield blocks(held, dealt, packer)

    found = rows.mapInArrow(run, "block int, stripes binary").repartition("block").sortWithinPartitions("block")
    return stage(found.mapInArrow(merged_blocks, STRIPE), "stripes")


# Scores


def lookups(candidates: DataFrame, phrases: DataFrame) -> DataFrame:
    """The frequencies of the parts of each phrase: left (``l``) and right of each cut.

    The join by part is followed by a grouping by phrase, so a part that many phrases share
    may be split over tasks.
    """
    words = F.split("phrase", " ")
    size = F.col("size")

    def part(column: str, first, length, present) -> F.Column:
        phrase = F.concat_ws(" ", F.slice(words, first, length))
        return F.when(present, F.struct(F.lit(column).alias("need"), phrase.alias("part")))

    needs = []
    for k in range(1, LONGEST):
        needs.append(part(f"l{k}", F.lit(1), F.lit(k), size > k))
        needs.append(part(f"r{k}", F.lit(k + 1), F.greatest(size - k, F.lit(0)), size > k))
    needed = candidates.select("lang", "phrase", F.inline(F.array_compact(F.array(*needs))))
    parts = phrases.where(F.col("size") < LONGEST).select("lang", F.col("phrase").alias("part"), F.col("a").alias("value"))
    return needed.join(parts, ["lang", "part"]).select("lang", "phrase", "need", "value")


def scored(documents: DataFrame, filter_bits: int = FILTER_BITS) -> DataFrame:
    """All candidates that no longer one subsumes: lang, phrase, size, a, l, r, n, score."""
    stripes = stripes_of(documents, filter_bits)
    phrases = entries(stripes)
    candidates = phrases.where("size > 1")
    # The greatest extensions, to the right out of the phrase's own stripe, to the left out
    # of phrases that leave it without their first word.
    right = stripes.where("size > 1").select("lang", F.col("prefix").alias("phrase"), F.array_max("counts").alias("value"))
    rest = F.concat_ws(" ", F.slice(F.split("phrase", " "), F.lit(2), F.col("size") - 1))
    left = candidates.where("size > 2").select("lang", rest.alias("phrase"), F.col("a").alias("value"))
    own = candidates.select("lang", "phrase", F.lit("a").alias("need"), F.col("a").alias("value"))
    extensions = right.unionByName(left).select("lang", "phrase", F.lit("own").alias("need"), "value")
    needs = ["a", "own", *(f"{side}{k}" for k in range(1, LONGEST) for side in "lr")]
    rows = (
        lookups(candidates, phrases)
        .unionByName(extensions)
        .unionByName(own)
        .groupBy("lang", "phrase")
        .agg(*(F.max(F.when(F.col("need") == need, F.col("value"))).alias(need) for need in needs))
        .where("a is not null")
    )
    rows = rows.where(
        f"own is null or 100 * cast(own as decimal(20,0)) < {SUBSUMED_PERCENT} * cast(a as decimal(20,0))"
    )
    cuts = ", ".join(
        f"if(l{k} is null, null, struct(cast({SCALE} * cast(a as decimal(20,0)) div"
        f" (cast(l{k} as decimal(20,0)) + cast(r{k} as decimal(20,0))) as long) as score, {k} as k, l{k} as l, r{k} as r))"
        for k in range(1, LONGEST)
    )
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y)
    n = stripes.where("size = 0").groupBy("lang").agg(F.sum(total).alias("n"))
    size = F.size(F.split("phrase", " "))
    return (
        rows.select("lang", "phrase", "a", F.expr(f"array_min(array({cuts}))").alias("cut"))
        .join(n, "lang")
        .select("lang", "phrase", size.alias("size"), "a", "cut.l", "cut.r", "n", "cut.score")
    )


def top_phrases(documents: DataFrame, top: int = TOP, filter_bits: int = FILTER_BITS) -> DataFrame:
    """The first ``top`` phrases of each language, ranked from 1."""
    rows = scored(documents, filter_bits).withColumn("deal", F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS)))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    for by in (["lang", "deal"], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        rows = rows.withColumn("rank", place).where(F.col("rank") <= top)
    return rows.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
