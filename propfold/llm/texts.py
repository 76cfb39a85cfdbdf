"""Words of whole texts as arrays: tokenising and hashing inside Arrow batches.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return. Texts are taken as UTF-8 bytes straight from the Arrow buffers, so no
Python string is made per word. A null text has no bytes and no words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

# Bytes of text handled at once; arrays of eight bytes per byte of text are made.
CHUNK_BYTES = 1 << 21

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """Each 64-bit number scrambled so that all its bits depend on all others."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def numbers(seed: int, count: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit numbers."""
    start = np.uint64((seed * _ODD) & _MASK)
    with np.errstate(over="ignore"):
        return mixed(start + np.arange(1, count + 1, dtype=np.uint64) * np.uint64(_ODD))


BYTES = numbers(1, 256)
# The same table with A-Z read as a-z.
BYTES_LOWER = BYTES.copy()
BYTES_LOWER[65:91] = BYTES[97:123]

_BASE = 0xD1342543DE82EF95
_powers: dict[str, np.ndarray] = {}


def powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    have = _powers.get("up")
    if have is None or len(have) < length:
        size = max(length, CHUNK_BYTES)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            out = np.full(size, base, dtype=np.uint64)
            out[0] = 1
            _powers[name] = np.multiply.accumulate(out, dtype=np.uint64)
    return _powers["up"], _powers["down"]


class Chunk(NamedTuple):
    """Some whole rows of a batch: their bytes, and where each row begins."""

    first: int
    data: np.ndarray
    offsets: np.ndarray  # one more than rows, from 0

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


class Words(NamedTuple):
    """Words of a chunk in order, and how many words precede each row."""

    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    first: np.ndarray  # one more than rows


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Rows of a text or binary column in order, at most ``limit`` bytes at once.

    A longer text is a chunk of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(at, dtype=np.int64 if large else np.int32)
    offsets = offsets[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    begin = 0
    while begin < n:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1
        end = min(max(end, begin + 1), n)
        part = offsets[begin : end + 1]
        yield Chunk(begin, data[part[0] : part[-1]], part - part[0])
        begin = end


def words(chunk: Chunk) -> Words:
    solid = ~SPACE[chunk.data]
    n, offsets = len(solid), chunk.offsets
    if not n:
        none = np.zeros(0, dtype=np.int64)
        return Words(none, none, none, np.zeros(len(offsets), dtype=np.int64))
    before = np.empty(n, dtype=bool)
    before[0], before[1:] = False, solid[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after = np.empty(n, dtype=bool)
    after[-1], after[:-1] = False, solid[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(solid & ~before)
    ends = np.flatnonzero(solid & ~after) + 1
    first = np.searchsorted(starts, offsets, side="left")
    row = np.repeat(np.arange(chunk.rows), np.diff(first))
    return Words(starts, ends, row, first)


def word_hashes(chunk: Chunk, found: Words, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word's bytes; with ``lower``, A-Z count as a-z."""
    table = BYTES_LOWER if lower else BYTES
    out = np.empty(len(found.starts), dtype=np.uint64)
    begin = 0
    with np.errstate(over="ignore"):
        while begin < len(out):
            base = found.starts[begin]
            end = int(np.searchsorted(found.ends, base + CHUNK_BYTES, side="right"))
            end = max(end, begin + 1)
            part = chunk.data[base : found.ends[end - 1]]
            up, down = powers(len(part) + 1)
            total = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum(table[part] * up[: len(part)], out=total[1:])
            a, b = found.starts[begin:end] - base, found.ends[begin:end] - base
            out[begin:end] = (total[b] - total[a]) * down[a] + (b - a).astype(np.uint64)
            begin = end
        return mixed(out)


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words within a row, and the index of its first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    inside = np.ones(n, dtype=bool)
    for begin in range(1, size):
        cut = first[1:-1] - begin
        inside[cut[(cut >= 0) & (cut < n)]] = False
    at = np.flatnonzero(inside)
    with np.errstate(over="ignore"):
        out = np.zeros(len(at), dtype=np.uint64)
        for k in range(size):
            out = out * np.uint64(0xA0761D6478BD642F) + hashes[at + k]
        return mixed(out + np.uint64(size)), at


def row_lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Consecutive values as one list for each row."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def row_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each row, the same wherever the row stands; no values: 0."""
    out = np.zeros(len(first) - 1, dtype=np.float64)
    full = np.flatnonzero(first[1:] > first[:-1])
    if len(full):
        out[full] = np.add.reduceat(values, first[:-1][full])
    return out
