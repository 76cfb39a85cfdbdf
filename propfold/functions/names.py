"""Normal form of event and property names.

Two raw spellings mean the same event or property when their normal forms are
equal. Everything here is a built-in column expression.
"""

from __future__ import annotations

import unicodedata
from functools import cache
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propfold.functions import scripts

# The replacements made before transliteration, in this order.
REPLACEMENTS = [("|", ""), (" ", "_"), ("__", "_"), ("___", "_")]

# Letters and signs written as one ASCII character, though Unicode
# gives them no decomposition.
SINGLE = {
    "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ħ": "h", "Ħ": "H",
    "ı": "i", "ł": "l", "Ł": "L", "ſ": "s", "ĸ": "k", "ŧ": "t", "Ŧ": "T",
    "ª": "a", "º": "o", "¹": "1", "²": "2", "³": "3", "µ": "u", "¡": "!", "¿": "?",
    "·": "*", "×": "x", "÷": "/", "´": "'", "¸": ",", "¦": "|", "¶": "P", " ": " ",
    "¨": '"', "¬": "!", "¯": "-", "Ŀ": "L", "ŀ": "l",
    "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "•": "*",
}

# Letters and signs written as several ASCII characters.
SEVERAL = {
    "ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th",
    "ĳ": "ij", "Ĳ": "IJ", "ŋ": "ng", "Ŋ": "NG", "€": "EUR", "©": "(c)", "®": "(r)",
    "¢": "C/", "£": "PS", "¤": "$?", "¥": "Y=", "§": "SS", "ŉ": "'n", "°": "deg", "±": "+-", "«": "<<", "»": ">>", "—": "--", "…": "...",
}

COMBINING = "".join(map(chr, range(0x300, 0x370)))
BEYOND_ASCII = r"[^\x00-\x7F]"
# Where letters of other scripts may be, and other forms of ASCII characters.
BEYOND_LATIN = r"[\x{BC}-\x{BE}\x{370}-\x{1DFF}\x{1F00}-\x{1FFF}\x{2070}-\x{218F}\x{2460}-\x{24FF}\x{3040}-\x{30FF}\x{A620}-\x{10FFFF}]"

# Spellings up to this length are sent out with their normal form.
KNOWN_LENGTH = 256


def accented_letters() -> dict[str, str]:
    """Latin letters that decompose into one ASCII letter and accents."""
    found = {}
    for letter in map(chr, chain(range(0xC0, 0x250), range(0x1E00, 0x1F00))):
        base, *marks = unicodedata.normalize("NFD", letter)
        if marks and base.isascii() and all(map(unicodedata.combining, marks)):
            found[letter] = base
    return found


@cache
def one_to_one() -> tuple[str, str]:
    """Arguments of ``translate``; combining accents at the end are removed."""
    others = {letter: plain for letter, plain in scripts.letters().items() if len(plain) == 1}
    table = {**others, **accented_letters(), **SINGLE}
    return "".join(table) + COMBINING, "".join(table.values())


def column(name: str, parent: str = "") -> Column:
    """Reference to a column whose name may hold any character."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(f"{parent}.{quoted}" if parent else quoted)


def literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


@cache
def several_letters() -> dict[str, str]:
    return {letter: plain for letter, plain in scripts.letters().items() if len(plain) > 1}


def other_scripts(text: str) -> str:
    """SQL expression for letters of other scripts that take several ASCII characters."""
    table = several_letters()
    known = f"map_from_arrays(split({literal(' '.join(table))}, ' '), split({literal(' '.join(table.values()))}, ' '))"
    place = f"(ascii(c) - {scripts.HANGUL_FIRST})"
    numbers = (f"{place} div 588", f"{place} % 588 div 28", f"{place} % 28")
    parts = [
        f"replace(split({literal(' '.join(names))}, ' ')[int({number})], '.', '')"
        for names, number in zip(scripts.HANGUL, numbers, strict=True)
    ]
    syllable = f"{place} between 0 and {scripts.HANGUL_LAST - scripts.HANGUL_FIRST}"
    one = f"coalesce(try_element_at({known}, c), if({syllable}, concat({', '.join(parts)}), c))"
    return f"array_join(transform(regexp_extract_all({text}, '(?s).', 0), c -> {one}), '')"


def normal_form(column: str) -> str:
    """SQL expression for the normal form of a column."""
    text = column
    for old, new in REPLACEMENTS:
        text = f"replace({text}, {literal(old)}, {literal(new)})"
    old, new = one_to_one()
    written = f"if({column} rlike {literal(BEYOND_LATIN)}, {other_scripts(text)}, {text})"
    written = f"translate({written}, {literal(old)}, {literal(new)})"
    for sign, letters in SEVERAL.items():
        written = f"replace({written}, {literal(sign)}, {literal(letters)})"
    return f"if({column} rlike {literal(BEYOND_ASCII)}, {written}, {text})"


def identifier(column: str) -> Column:
    """Lower-case normal form: the name of a table or column."""
    return F.expr(f"lower({normal_form(column)})")


def comparison_key(column: str) -> Column:
    """Upper-case normal form: what two spellings are compared by."""
    return F.expr(f"upper({normal_form(column)})")


def with_identifier(
    rows: DataFrame, name: str, out: str, known: dict[str, str] | None = None
) -> DataFrame:
    """Add ``out``, the identifier of column ``name``.

    ``known`` are registered spellings with what they stand for, which came from the
    driver and are broadcast. A spelling that it does not hold is normalised in place.
    """
    if not known:
        return rows.withColumn(out, identifier(name))
    table = rows.sparkSession.createDataFrame(sorted(known.items()), "_raw string, _known string")
    return (
        rows.join(F.broadcast(table), rows[name] == table["_raw"], "left")
        .withColumn(out, F.coalesce("_known", identifier(name)))
        .drop("_raw", "_known")
    )
