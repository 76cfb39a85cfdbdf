"""Which ids of a table have been taken in: exact intervals, late ids included.

Seen ids are kept as islands, runs of consecutive ids within a block of ``2**BLOCK_BITS``
ids: ``block``, ``first``, ``last``. A gap between islands is unseen, so a row that turns
up late in it is found. The longest seen ranges go into the scan as a predicate on the id,
which lets a table written in that order skip them; what these ranges do not say is
settled by anti-joins with the remaining islands, so their number costs no result. Of long
islands a block has few, which are joined as they are; short ones are laid out as bits, one
row for ``2**WORD_BITS`` ids, so that a row meets one row of them however many there are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BITS = 16
WORD_BITS = 6  # the bits of a long
LONG_ISLAND = 1024  # ids of an island that is joined as it is
GROUP_BITS = 26  # ids whose islands are looked at one by one, unless all of them are seen

# What the driver holds of islands, and how many ranges a scan is given.
MAX_ISLANDS = 100_000
MAX_RANGES = 64

ISLANDS = "block LONG, first LONG, last LONG"


def word_of(id: Column) -> Column:
    return F.shiftright(id, WORD_BITS)


def bit_of(id: Column) -> Column:
    """Place of the id in its word."""
    return id.bitwiseAND((1 << WORD_BITS) - 1).cast("int")


def bits(mask: Column) -> Column:
    """Places of the bits that are set, in order."""
    places = F.sequence(F.lit(0), F.lit((1 << WORD_BITS) - 1))
    return F.filter(places, lambda place: F.getbit(mask, place) == 1)


def islands(rows: DataFrame, key: str = "id") -> DataFrame:
    """Runs of consecutive ids; an id that occurs twice counts once, NULL not at all.

    Ids are combined into words before they are shuffled; runs within a word are read off
    its bits, and only runs are sorted.
    """
    ids = rows.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), bit_of(F.col("id")))
    words = ids.groupBy(word_of(F.col("id")).alias("word")).agg(F.bit_or(bit).alias("mask"))
    mask, start = F.col("mask"), F.shiftleft("word", WORD_BITS)
    begins = mask.bitwiseAND(F.bitwise_not(F.shiftleft(mask, 1)))
    ends = mask.bitwiseAND(F.bitwise_not(F.shiftrightunsigned(mask, 1)))
    runs = (
        words.select(start.alias("start"), F.inline(F.arrays_zip(bits(begins).alias("a"), bits(ends).alias("b"))))
        .select((F.col("start") + F.col("a")).alias("first"), (F.col("start") + F.col("b")).alias("last"))
        .withColumn("block", F.shiftright("first", BLOCK_BITS))
    )
    # Within an island, a run begins behind the end of the one before.
    along = Window.partitionBy("block").orderBy("first")
    apart = F.coalesce(F.col("first") - F.lag("last").over(along) > 1, F.lit(True))
    return (
        runs.withColumn("apart", apart.cast("long"))
        .withColumn("island", F.sum("apart").over(along))
        .groupBy("block", "island")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .drop("island")
    )


def island_words(seen: DataFrame) -> DataFrame:
    """Islands as ``_word`` and ``_mask``: one row for each word with a seen id."""
    top = (1 << WORD_BITS) - 1
    cut = seen.select(
        "first", "last", F.explode(F.sequence(word_of(F.col("first")), word_of(F.col("last")))).alias("_word")
    )
    start = F.shiftleft("_word", WORD_BITS)
    low = F.greatest("first", start) - start
    high = F.least("last", start + top) - start
    ones = F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), (top - high + low).cast("int"))
    mask = F.call_function("shiftleft", ones, low.cast("int"))
    return cut.select("_word", mask.alias("mask")).groupBy("_word").agg(F.bit_or("mask").alias("_mask"))


def joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, neighbours made one."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def seen_ranges(
    seen: DataFrame,
    group_bits: int = GROUP_BITS,
    max_islands: int = MAX_ISLANDS,
    max_ranges: int = MAX_RANGES,
) -> list[tuple[int, int]]:
    """The longest ranges all of whose ids are seen, in order.

    Groups of ids that are seen as a whole come to the driver as one row each; of the rest
    the longest islands do.
    """
    size = F.col("last") - F.col("first") + 1
    group = F.shiftright("first", group_bits).alias("group")
    rows = seen.select("first", "last", size.alias("size"), group)
    full = rows.groupBy("group").agg(F.sum("size").alias("n")).where(F.col("n") == 1 << group_bits)
    full = full.select("group").orderBy("group").limit(max_islands)
    whole = [(r["group"] << group_bits, (r["group"] + 1 << group_bits) - 1) for r in full.collect()]
    parts = rows.join(F.broadcast(full), "group", "left_anti").orderBy(F.col("size").desc(), "first")
    found = joined(whole + [(r["first"], r["last"]) for r in parts.limit(max_islands).collect()])
    longest = sorted(found, key=lambda x: x[0] - x[1])[:max_ranges]
    return sorted(longest)


def outside(key: Column, ranges: list[tuple[int, int]]) -> Column:
    """Ids in none of the ranges, as comparisons that a scan can use."""
    if not ranges:
        return F.lit(True)
    gaps = [(a[1], b[0]) for a, b in zip(ranges[:-1], ranges[1:], strict=True)]
    parts = [key < ranges[0][0], *((key > a) & (key < b) for a, b in gaps), key > ranges[-1][1]]
    return reduce(Column.__or__, parts)


def unseen(
    rows: DataFrame, seen: DataFrame, key: str = "id", ranges: list[tuple[int, int]] | None = None
) -> DataFrame:
    """Rows whose id is in no island. ``seen`` is read more than once: a stored table."""
    ranges = seen_ranges(seen) if ranges is None else ranges
    left = rows.where(F.col(key).isNotNull() & outside(F.col(key), ranges))
    # An island lies in a range as a whole or not at all.
    rest = seen.where(outside(F.col("first"), ranges))
    small = F.col("last") - F.col("first") < LONG_ISLAND - 1
    n = rest.agg(F.count_if(small).alias("short"), F.count_if(~small).alias("long")).first()
    if n["long"]:
        long = rest.where(~small).select("block", F.col("first").alias("_first"), F.col("last").alias("_last"))
        same = F.shiftright(left[key], BLOCK_BITS) == long["block"]
        left = left.join(long, same & left[key].between(long["_first"], long["_last"]), "left_anti")
    if n["short"]:
        words, id = island_words(rest.where(small)), left[key].cast("long")
        known = F.getbit(words["_mask"], bit_of(id)) == 1
        left = left.join(words, (word_of(id) == words["_word"]) & known, "left_anti")
    return left
