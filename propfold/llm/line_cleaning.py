"""Line-first cleaning: rules remove lines, and texts that lose too much are rejected.

Each line (between line feeds) that holds a word is judged by itself:

* punctuation: it must end as a sentence does, and must not be made of symbols or
  exclamation marks;
* navigation: it must not be a row of separators, as menus and tables are;
* boilerplate: a short line must not hold a stock phrase of web pages.

Failing lines are removed. A text is rejected if it loses more than ``max_lost`` of its
words, or if it fails the base rules on the whole text: too few words, or more than half
of them inside three-word windows that occur twice.

Null and empty texts have no words and fail the base rules. Rows are judged one by one,
so repeated rows get equal results, and further columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propfold.llm import texts

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST = 0.4
# A line is symbols if there are more of them than this for each word.
MAX_SYMBOLS_PER_WORD = 0.5
MAX_SEPARATOR_SHARE = 0.2
MIN_SEPARATORS = 3
# Stock phrases count in lines of at most so many words.
BOILERPLATE_WORDS = 20

SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>")] = True
BLANK = b" \t\n\r\x0b\x0c"
SENTENCE_ENDS = tuple(x.encode() for x in ". ! ? : ; … ” \" ' ) ] » 。 ！ ？".split())
SEPARATORS = (b"|", b"\xc2\xbb", b"\xc2\xb7", b"\xe2\x80\xa2", b">", b"/")
BOILERPLATE = (
    b"all rights reserved",
    b"cookie",
    b"privacy policy",
    b"terms of use",
    b"terms of service",
    b"lorem ipsum",
    b"javascript",
    b"subscribe to",
    b"sign up",
    b"log in",
    b"click here",
    b"read more",
    b"share this",
    b"skip to content",
)

STATISTICS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_lines_removed long, n_words_removed long"
)


def line_fails(line: bytes, found: list[bytes]) -> str | None:
    """The rule that a line fails; ``found`` are its words."""
    n = len(found)
    separators = sum(word in SEPARATORS for word in found)
    if separators >= MIN_SEPARATORS and separators > MAX_SEPARATOR_SHARE * n:
        return "navigation"
    if not line.rstrip(BLANK).endswith(SENTENCE_ENDS):
        return "punctuation"
    symbols = sum(line.count(c) for c in (b"#", b"*", b"$", b"%", b"&", b"!"))
    if symbols > MAX_SYMBOLS_PER_WORD * n + 2:
        return "punctuation"
    if n <= BOILERPLATE_WORDS:
        low = line.lower()
        if any(phrase in low for phrase in BOILERPLATE):
            return "boilerplate"
    return None


def repeated_words(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of each row, the words inside three-word windows that it holds twice or more."""
    out = np.zeros(len(first) - 1, dtype=np.int64)
    keys, at = texts.windows(hashes, first, 3)
    bounds = np.searchsorted(at, first, side="left")
    for row in np.flatnonzero(np.diff(bounds) > 1):
        a, b = bounds[row], bounds[row + 1]
        order = np.argsort(keys[a:b], kind="stable")
        k = keys[a:b][order]
        same = k[1:] == k[:-1]
        if not same.any():
            continue
        twice = np.zeros(b - a, dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        covered = np.zeros(b - a + 2, dtype=bool)
        for k in range(3):
            covered[k : k + b - a] |= twice
        out[row] = covered.sum()
    return out


def cleaned(batch: pa.RecordBatch, with_text: bool) -> pa.RecordBatch:
    columns: dict[str, list] = {name.split()[0]: [] for name in STATISTICS.split(", ")}
    kept_texts: list[str] = []
    for chunk in texts.chunks(batch.column("text")):
        found = texts.words(chunk)
        hashes = texts.word_hashes(chunk, found)
        at = chunk.offsets
        solid = np.zeros(len(chunk.data) + 1, dtype=np.int64)
        np.cumsum(~texts.SPACE[chunk.data] & ((chunk.data & 0xC0) != 0x80), out=solid[1:])
        symbols = np.zeros(len(chunk.data) + 1, dtype=np.int64)
        np.cumsum(SYMBOL[chunk.data], out=symbols[1:])
        columns["n_words"].append(np.diff(found.first))
        columns["word_chars"].append(solid[at[1:]] - solid[at[:-1]])
        columns["n_symbols"].append(symbols[at[1:]] - symbols[at[:-1]])
        columns["n_repeat_words"].append(repeated_words(hashes, found.first))
        counts = np.zeros((chunk.rows, 4), dtype=np.int64)
        whole = chunk.data.tobytes()
        for row in range(chunk.rows):
            seen, kept = set(), []
            lines = copies = removed = lost = 0
            for line in whole[at[row] : at[row + 1]].split(b"\n"):
                line_words = line.split()
                if line_words:
                    lines += 1
                    if line in seen:
                        copies += 1
                    seen.add(line)
                    if line_fails(line, line_words):
                        removed += 1
                        lost += len(line_words)
                        continue
                if with_text:
                    kept.append(line)
            counts[row] = copies, lines, removed, lost
            if with_text:
                kept_texts.append(b"\n".join(kept).decode("utf-8", "replace"))
        names = ("n_dup_lines", "n_lines", "n_lines_removed", "n_words_removed")
        for k, name in enumerate(names):
            columns[name].append(counts[:, k])
    arrays = [batch.column("doc_id")]
    arrays += [pa.array(np.concatenate(v or [[]]).astype(np.int64)) for v in columns.values()]
    if with_text:
        arrays.append(pa.array(kept_texts, type=pa.string()))
    return pa.RecordBatch.from_arrays(
        arrays, names=["doc_id", *columns, *(["clean_text"] if with_text else [])]
    )


def clean_lines(documents: DataFrame, max_lost: float = MAX_LOST, with_text: bool = True):
    """Statistics and verdict of each row, and its text without the failing lines.

    ``base_failed`` says that the whole text fails the base rules, ``kept`` that it
    passes them and loses at most ``max_lost`` of its words. ``clean_text`` is given for
    rejected texts as well. There is no shuffle.
    """
    rows = documents.select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield cleaned(batch, with_text)

    kind = rows.schema["doc_id"].dataType.simpleString()
    text = ", clean_text string" if with_text else ""
    out = rows.mapInArrow(run, f"doc_id {kind}, {STATISTICS}{text}")
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    lost = F.col("n_words_removed") <= F.lit(max_lost) * F.col("n_words")
    return out.withColumns({"base_failed": base_failed, "kept": ~base_failed & lost})
