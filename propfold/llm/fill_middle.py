"""Fill-in-middle transformation over texts kept as seekable compressed frames.

A text is stored as independent zstandard frames of at most ``FRAME_BYTES`` bytes, cut
between code points, with the number of code points up to the end of each frame. A range
of code points is found by these counts: only the frames that hold its ends are cut, and
frames outside it are not decompressed. The transformed text is written frame by frame
into frames of its own, and the original is read back out of those by its markers alone.
Digests are taken over the frames in order, so a task holds one row's compressed frames
and one decompressed frame, however long the text is. There is no shuffle.

Texts are UTF-8 bytes, units are code points. The four draws of a row are the first four
groups of eight hexadecimal digits of the SHA-256 of ``seed:doc_id``. A null or empty text
has no units and stays plain. Rows without a ``doc_id`` draw as if it were the empty text;
repeated rows draw alike, and each comes back. A text that holds a marker stays plain.
Columns of the documents come back as one struct, so their names meet none of the new
ones. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from propfold.llm.staging import stage

FRAME_BYTES = 1 << 16
LEVEL = 3
SEED = 1
CHANGED_PERCENT = 90
SPM_PERCENT = 20

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
MARK_UNITS = 3


class Frames(NamedTuple):
    """Compressed frames of a text, and the units up to the end of each."""

    ends: Sequence[int]
    blobs: Sequence[bytes]

    @property
    def units(self) -> int:
        return self.ends[-1] if len(self.ends) else 0


def unit_starts(data: bytes) -> np.ndarray:
    """Where the code points of a piece of UTF-8 begin."""
    return np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)


def count_units(data: bytes) -> int:
    return len(data) if data.isascii() else len(unit_starts(data))


class FrameWriter:
    """Takes a text in pieces and keeps it as compressed frames."""

    def __init__(self, packer: zstandard.ZstdCompressor, size: int = FRAME_BYTES):
        self.packer, self.size = packer, size
        self.waiting = bytearray()
        self.ends: list[int] = []
        self.blobs: list[bytes] = []

    def write(self, piece: bytes) -> None:
        self.waiting += piece
        at = 0
        while len(self.waiting) - at > self.size:
            end = at + self.size
            for _ in range(3):  # a code point has at most three bytes after its first
                if self.waiting[end] & 0xC0 == 0x80:
                    end -= 1
            self.add(bytes(self.waiting[at:end]))
            at = end
        del self.waiting[:at]

    def add(self, data: bytes) -> None:
        self.ends.append((self.ends[-1] if self.ends else 0) + count_units(data))
        self.blobs.append(self.packer.compress(data))

    def close(self) -> Frames:
        if self.waiting:
            self.add(bytes(self.waiting))
        return Frames(self.ends, self.blobs)


def read_units(frames: Frames, start: int, stop: int, unpacker: zstandard.ZstdDecompressor) -> Iterator[bytes]:
    """The units from ``start`` up to ``stop`` in order, a frame at a time."""
    if stop <= start:
        return
    for k in range(bisect_right(frames.ends, start), bisect_left(frames.ends, stop) + 1):
        if k == len(frames.ends):
            return
        first = frames.ends[k - 1] if k else 0
        data = unpacker.decompress(frames.blobs[k])
        if start > first or stop < frames.ends[k]:
            low, high = max(start - first, 0), min(stop, frames.ends[k]) - first
            if not data.isascii():
                starts = np.append(unit_starts(data), len(data))
                low, high = int(starts[low]), int(starts[high])
            data = data[low:high]
        yield data


def find_mark(frames: Frames, mark: bytes, start: int, unpacker: zstandard.ZstdDecompressor) -> int:
    """The unit at which ``mark`` is first found from ``start`` on; -1 if it is nowhere."""
    at, rest = start, b""
    for data in read_units(frames, start, frames.units, unpacker):
        held = rest + data
        place = held.find(mark)
        if place >= 0:
            return at + count_units(held[:place])
        kept = min(len(mark) - 1, len(held))
        while kept and held[-kept] & 0xC0 == 0x80:
            kept -= 1  # a mark is ASCII, so none begins inside a code point
        at += count_units(held[: len(held) - kept])
        rest = held[len(held) - kept :]
    return -1


def output_pieces(frames: Frames, form: str, a: int, b: int, unpacker: zstandard.ZstdDecompressor) -> Iterator[bytes]:
    """The transformed text in order: the middle lies from unit ``a`` up to unit ``b``."""
    n = frames.units
    if form == "plain":
        yield from read_units(frames, 0, n, unpacker)
        return
    order = [(PREFIX, 0, a), (SUFFIX, b, n)]
    for mark, low, high in (order if form == "psm" else order[::-1]) + [(MIDDLE, a, b)]:
        yield mark
        yield from read_units(frames, low, high, unpacker)


def restored_pieces(output: Frames, form: str, unpacker: zstandard.ZstdDecompressor) -> Iterator[bytes]:
    """The original text in order, out of the transformed one and its form."""
    if form == "plain":
        yield from read_units(output, 0, output.units, unpacker)
        return
    second = find_mark(output, SUFFIX if form == "psm" else PREFIX, MARK_UNITS, unpacker)
    third = find_mark(output, MIDDLE, second + MARK_UNITS, unpacker)
    spans = [(MARK_UNITS, second), (second + MARK_UNITS, third)]
    prefix, suffix = spans if form == "psm" else spans[::-1]
    for low, high in (prefix, (third + MARK_UNITS, output.units), suffix):
        yield from read_units(output, low, high, unpacker)


def sha256(pieces: Iterable[bytes]) -> str:
    digest = hashlib.sha256()
    for piece in pieces:
        digest.update(piece)
    return digest.hexdigest()


# Tables of frames


STORE = "n long, marked boolean, frame_ends array<long>, frames array<binary>"


def frame_store(documents: DataFrame, columns: list[str] | None = None, size: int = FRAME_BYTES) -> DataFrame:
    """Texts as frames: ``document`` (the given columns, by default all but the text),
    ``n`` units, whether the text holds a marker, ``frame_ends`` and ``frames``."""
    columns = [c for c in documents.columns if c != "text"] if columns is None else columns
    rows = documents.select(
        F.struct(*columns).alias("document"), F.col("text").cast("string").cast("binary").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            made, marked = [], []
            for cell in batch.column("text"):
                text, writer = cell.as_py() or b"", FrameWriter(packer, size)
                for at in range(0, len(text), size):
                    writer.write(text[at : at + size])
                made.append(writer.close())
                marked.append(any(mark in text for mark in MARKS))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("document"),
                    pa.array([f.units for f in made], pa.int64()),
                    pa.array(marked, pa.bool_()),
                    pa.array([f.ends for f in made], pa.list_(pa.int64())),
                    pa.array([f.blobs for f in made], pa.list_(pa.binary())),
                ],
                names=["document", "n", "marked", "frame_ends", "frames"],
            )

    shape = StructType([rows.schema["document"], *StructType.fromDDL(STORE)])
    return rows.mapInArrow(run, shape)


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """The four draws of a row as whole numbers below 2**32."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(key.cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def with_cuts(store: DataFrame, seed: int = SEED) -> DataFrame:
    """A store with the form of each row and the two units between which the middle lies."""
    h1, h2, h3, h4 = draws(F.col("document.doc_id"), seed)
    first, second = F.pmod(h1, F.col("n") + 1), F.pmod(h2, F.col("n") + 1)
    plain = (F.col("n") == 0) | F.col("marked") | (F.pmod(h3, F.lit(100)) >= CHANGED_PERCENT)
    form = F.when(plain, "plain").when(F.pmod(h4, F.lit(100)) < SPM_PERCENT, "spm").otherwise("psm")
    return store.select(
        "document",
        "n",
        form.alias("form"),
        F.least(first, second).alias("low"),
        F.greatest(first, second).alias("high"),
        "frame_ends",
        "frames",
    )


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple[Frames, str, int, int]]:
    columns = (batch.column(c) for c in ("frame_ends", "frames", "form", "low", "high"))
    for ends, blobs, form, low, high in zip(*columns, strict=True):
        yield Frames(ends.as_py(), blobs.as_py()), form.as_py(), low.as_py(), high.as_py()


def spans() -> list[Column]:
    changed = F.col("form") != "plain"
    return [
        "n",
        "form",
        F.when(changed, F.col("low")).alias("prefix_chars"),
        F.when(changed, F.col("high") - F.col("low")).alias("middle_chars"),
    ]


def transformed(store: DataFrame, seed: int = SEED) -> DataFrame:
    """``document``, the text after the transformation as ``output``, its form and cuts."""
    rows = with_cuts(store, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            out = [b"".join(output_pieces(*row, unpacker)) for row in rows_of(batch)]
            same = [batch.column(c) for c in ("document", "n", "form", "low", "high")]
            yield pa.RecordBatch.from_arrays(
                [*same, pa.array(out, pa.binary())], names=["document", "n", "form", "low", "high", "output"]
            )

    shape = StructType([*rows.schema.fields[:5], *StructType.fromDDL("output binary")])
    made = rows.mapInArrow(run, shape)
    return made.select("document", *spans(), F.col("output").cast("string").alias("output"))


def digests(store: DataFrame, seed: int = SEED) -> DataFrame:
    """``document``, form, cuts, and the SHA-256 of the output and of what it is read back to."""
    rows = with_cuts(store, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, unpacker = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
        for batch in batches:
            outputs, restored = [], []
            for row in rows_of(batch):
                writer, digest = FrameWriter(packer), hashlib.sha256()
                for piece in output_pieces(*row, unpacker):
                    digest.update(piece)
                    writer.write(piece)
                outputs.append(digest.hexdigest())
                restored.append(sha256(restored_pieces(writer.close(), row[1], unpacker)))
            same = [batch.column(c) for c in ("document", "n", "form", "low", "high")]
            yield pa.RecordBatch.from_arrays(
                [*same, pa.array(outputs, pa.string()), pa.array(restored, pa.string())],
                names=["document", "n", "form", "low", "high", "output_sha256", "restored_sha256"],
            )

    shape = StructType(
        [*rows.schema.fields[:5], *StructType.fromDDL("output_sha256 string, restored_sha256 string")]
    )
    return rows.mapInArrow(run, shape).select("document", *spans(), "output_sha256", "restored_sha256")


def fill_in_middle(documents: DataFrame, seed: int = SEED) -> DataFrame:
    """The transformed texts of whole documents, through a staged store of frames."""
    return transformed(stage(frame_store(documents), "frames"), seed)


def fill_in_middle_digest(documents: DataFrame, seed: int = SEED) -> DataFrame:
    """The digests of the transformed texts by ``doc_id``, through a staged store of frames."""
    store = stage(frame_store(documents, ["doc_id"]), "frames")
    made = digests(store, seed)
    return made.select("document.doc_id", *(c for c in made.columns if c != "document"))
