"""Best-fit packing of texts into sequences of several permitted lengths.

Items are packed by best fit, longest first: each goes to the open bin it leaves the
least room in. Where none has room, a bin is opened. Its size is the permitted one of least
cost for each token in it: every size is filled on trial with the longest items that are
left and fit. The packing is done in this way and once for each permitted size as the least
one to open, and the result of least total cost is taken, so all sizes are optimised
jointly. At the end each bin is downsized to the smallest permitted size that holds its
contents.

The cost of a sequence of n tokens is ``n + n * n / ATTENTION + OVERHEAD``.

Items longer than the largest size are cut into pieces of that size and a rest. Rows are
dealt by a hash of their place in the staged table, so equal rows part as well, to shards
of about ``SHARD`` rows, which are packed independently; a task holds one shard however
large the input is, and at most a few bins per shard are less full than in one packing of
all.

Null and empty texts have only their end marker, one token. Repeated rows are packed as
often as they occur. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propfold.llm.staging import stage

SIZES = (512, 1024, 2048, 4096, 8192)
ATTENTION = 16384
OVERHEAD = 32
SHARD = 40_000


def cost(size: int) -> float:
    return size + size * size / ATTENTION + OVERHEAD


class Left:
    """Lengths that are still to be packed, with the number of items of each."""

    def __init__(self, lengths: np.ndarray):
        values, counts = np.unique(lengths, return_counts=True)
        self.values: list[int] = values.tolist()  # ascending
        self.counts: dict[int, int] = dict(zip(self.values, counts.tolist(), strict=True))

    def take(self, length: int) -> None:
        self.counts[length] -= 1
        if not self.counts[length]:
            del self.values[bisect_left(self.values, length)]

    def fill(self, room: int) -> int:
        """Tokens that a bin holds if the longest items that fit go into it, one after the other."""
        used, at = 0, len(self.values)
        while room:
            at = bisect_right(self.values, room, 0, at)
            if not at:
                break
            at -= 1
            number = min(room // self.values[at], self.counts[self.values[at]])
            used += number * self.values[at]
            room -= number * self.values[at]
        return used


def opened(length: int, sizes: tuple[int, ...], left: Left) -> int:
    """Size of a bin to open for an item: of least cost for a token of what would fill it."""
    return min((s for s in sizes if s >= length), key=lambda s: cost(s) / (length + left.fill(s - length)))


def best_fit(
    lengths: np.ndarray, sizes: tuple[int, ...], floor: int | None
) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Bin and offset of each item, and how full each bin is; longest items first.

    A bin is opened at the smallest size from ``floor`` on that holds the item; without a
    floor, at the size that trial fillings find best.
    """
    bins, offsets, used, room = np.empty(len(lengths), int), np.empty(len(lengths), int), [], []
    free: list[int] = []  # amounts of room that some open bin has, ascending
    held: dict[int, list[int]] = {}
    waiting = Left(lengths) if floor is None else None
    for item, length in enumerate(lengths.tolist()):
        if waiting:
            waiting.take(length)
        at = bisect_left(free, length)
        if at < len(free):
            left = free[at]
            one = held[left].pop()
            if not held[left]:
                del held[left], free[at]
        else:
            one = len(used)
            left = opened(length, sizes, waiting) if waiting else min(s for s in sizes if s >= max(length, floor))
            used.append(0)
            room.append(left)
        bins[item], offsets[item] = one, used[one]
        used[one] += length
        left -= length
        if left:
            if left not in held:
                insort(free, left)
            held.setdefault(left, []).append(one)
    return bins, offsets, used


def packed(items: pd.DataFrame, sizes: tuple[int, ...]) -> pd.DataFrame:
    """One shard: columns bin, offset, bin_used and bin_size are added."""
    items = items.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
    lengths = items["length"].to_numpy()
    best = None
    for floor in (None, *sizes):
        bins, offsets, used = best_fit(lengths, sizes, floor)
        final = np.array(sizes)[np.searchsorted(sizes, used)]
        total = sum(cost(s) for s in final.tolist())
        if best is None or total < best[0]:
            best = total, bins, offsets, np.array(used), final
    _, bins, offsets, used, final = best
    shard = int(items["shard"].iloc[0])
    return pd.DataFrame(
        {
            "doc_id": items["doc_id"],
            "piece": items["piece"],
            "start": items["start"],
            "length": items["length"],
            "bin_id": (shard << 32) + bins,
            "bin_offset": offsets,
            "bin_used": used[bins],
            "bin_size": final[bins],
        }
    )


def word_count(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")), F.lit(0)).cast("long")


def pack(items: DataFrame, sizes: tuple[int, ...] = SIZES) -> DataFrame:
    """Pack ``items(doc_id, length)``; lengths are at least 1.

    Gives (doc_id, piece, start, length, bin_id, bin_offset, bin_used, bin_size), where
    start is the place of the piece in its document.
    """
    sizes, largest = tuple(sorted(sizes)), max(sizes)
    pieces = items.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "length",
        F.posexplode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(largest).cast("long"))).alias(
            "piece", "start"
        ),
    ).select(
        "doc_id", "piece", "start", F.least(F.col("length") - F.col("start"), F.lit(largest)).cast("long").alias("length")
    )
    pieces = stage(pieces.withColumn("place", F.monotonically_increasing_id()), "pieces")
    shards = max(1, -(-pieces.count() // SHARD))
    shard = F.pmod(F.xxhash64("place"), F.lit(shards)).cast("int")
    shape = (
        "doc_id long, piece int, start long, length long, bin_id long, bin_offset long, "
        "bin_used long, bin_size long"
    )
    return (
        pieces.withColumn("shard", shard)
        .groupBy("shard")
        .applyInPandas(lambda rows: packed(rows, sizes), shape)
    )


def document_items(documents: DataFrame) -> DataFrame:
    """Tokens of each text, its words and an end marker."""
    return documents.select("doc_id", (word_count(F.col("text")) + 1).alias("length"))
