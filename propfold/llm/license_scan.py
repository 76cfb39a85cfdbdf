"""License scans: sparse TF-IDF cosine to templates, and inheritance by directory.

A unit is a line of a text; the whole text of a licence file (a file named as one of
``FILE_NAMES``) is one as well, and so are windows: as many words of a text as a template
has, laid so that an anchor, a trigger word of the template, meets the same word of the
text. They run across lines and find notices within longer ones. Every such word of every text is
tried with every template of ``WINDOW`` words; of longer ones the first ``HEAD`` words are
a template. A window that could not reach ``LEAST``, were its other words free, is no unit. Units that hold a trigger word are compared with each template by the
cosine of their TF-IDF vectors over lower-case words; names and versions are words of
their own, and a version 2.0 is a 2. Templates are titles, notices, standard headers and
whole texts (``license_texts``). Inverse document frequencies of the
templates' words are counted over the lines of all documents; words of no template have
the frequency of a word that no line holds. An SPDX tag names its licence itself, at a
similarity of 1: identifiers without -only, -or-later and +, expressions as they are
written. The best template of the best unit, at a
cosine of ``LEAST`` or more, is the licence of the file; ties go to the unit that begins earlier, then
to the longer one, then to the name that comes first.

A file without a licence of its own inherits that of the licence file in the nearest
directory above it, by a join of its ancestor directories with the directories that hold
one. Several licence files in one directory: the best match counts.

Only DataFrame functions. Equal units are compared once, however often they occur. Words
are counted by term with map-side combining; what is broadcast are the templates' terms.

A null path has no directories and inherits nothing, null and empty texts have no units;
such rows come back without a licence unless they inherit one. Rows that share a path are
one file. Columns other than path, doc_id and text are not looked at.
"""

from __future__ import annotations

import json
import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propfold.llm import license_texts
from propfold.llm.staging import stage

# Short notices of common licences; license_texts has more of each, and more licences.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, "
    "are permitted under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under the Creative Commons Attribution license, CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under the Creative Commons Attribution-ShareAlike license, CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This work is subject to the terms of the Mozilla Public License, version 2.0.",
}
FILE_NAMES = ("LICENSE", "LICENCE", "COPYING", "LICENSE.txt", "LICENSE.md")
TRIGGER = r"(?i)licen[cs]e|copying|redistribut|spdx|permission|creative commons|public domain|\bcc[ -]?(?:by|0)\b"
# A name or a version; ".0" at the end of a version is left out before.
WORD = r"[a-z]+|[0-9]+(?:\.[0-9]+)*"
ZERO = r"(?<=[0-9])\.0(?!\.?[0-9])"
LEAST = 0.6

# An identifier has a capital or a digit, so that prose about the tag is none.
IDENTIFIER = r"\(*(?=[a-z.+-]*[A-Z0-9])[A-Za-z0-9][A-Za-z0-9.+-]*\)*"
SPDX = rf"(?i:SPDX-License-Identifier):?\s*({IDENTIFIER}(?:[ \t]+(?:AND|OR|WITH|and|or|with)[ \t]+{IDENTIFIER})*)"


def terms(text: str) -> Counter:
    return Counter(re.findall(WORD, re.sub(ZERO, "", text.lower())))


# Words of templates that are looked for in windows, fewest and most; a template of fewer
# words, a title, has to fill a line.
WINDOW = (5, 300)
HEAD = 60
# Words that windows are laid by, the rarer first; two of a template.
ANCHORS = (
    "sublicense", "unencumbered", "redistributions", "redistribution", "redistribute", "eclipse", "boost", "creative",
    "commons", "permission", "licensed", "mozilla", "mit", "apache", "license", "licence",
)


def heads(variants: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """The first words of templates too long for a window."""
    found = ((name, re.findall(WORD, re.sub(ZERO, "", text.lower()))) for name, text in variants)
    return [(name, " ".join(words[:HEAD])) for name, words in found if len(words) > WINDOW[1]]


# (license, text), several of a licence.
VARIANTS = list(dict.fromkeys([*TEMPLATES.items(), *license_texts.texts()]))
VARIANTS += heads(VARIANTS)
VOCABULARY = sorted(set().union(*(terms(text) for _, text in VARIANTS)))


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.regexp_replace(F.lower(text), ZERO, ""), F.lit(WORD), F.lit(0))


def line_counts(documents: DataFrame) -> tuple[int, dict[str, int]]:
    """Lines of all texts, and of each template word the lines that hold it."""
    lines = documents.select(F.explode(F.split("text", "\n")).alias("line")).where("trim(line) <> ''")
    known = small_table(documents.sparkSession, [(t,) for t in ["", *VOCABULARY]], "term string")
    found = lines.select(F.explode(F.concat(F.array(F.lit("")), F.array_distinct(words(F.col("line"))))).alias("term"))
    found = found.join(F.broadcast(known), "term")
    counts = {r["term"]: r["n"] for r in found.groupBy("term").agg(F.count("*").alias("n")).collect()}
    return counts.pop("", 0), counts


def inverse(count: int, lines: int) -> float:
    return math.log((1 + lines) / (1 + count)) + 1


def template_table(documents: DataFrame, lines: int, counts: dict[str, int]) -> DataFrame:
    """(template, license, term, part): unit vectors of the templates."""
    rows = []
    for k, (name, text) in enumerate(VARIANTS):
        vector = {t: n * inverse(counts.get(t, 0), lines) for t, n in terms(text).items()}
        norm = math.sqrt(sum(x * x for x in vector.values()))
        rows += [(k, name, t, x / norm) for t, x in sorted(vector.items())]
    return small_table(documents.sparkSession, rows, "template int, license string, term string, part double")


def anchors() -> list[tuple[int, str, int, int]]:
    """(template, word, place of the word, words) of templates that are looked for in windows."""
    out = []
    for k, (_, text) in enumerate(VARIANTS):
        found = re.findall(WORD, re.sub(ZERO, "", text.lower()))
        if WINDOW[0] <= len(found) <= WINDOW[1]:
            out += [(k, w, found.index(w), len(found)) for w in [w for w in ANCHORS if w in found][:2]]
    return out


def windows(rows: DataFrame, templates: DataFrame) -> DataFrame:
    """(path, is_file, place, unit, size) of ``rows(path, is_file, words)``; ``place`` counts words."""
    spark, laid = rows.sparkSession, anchors()
    reach = {w: max(max(q, n - q) for _, v, q, n in laid if v == w) for w in {w for _, w, _, _ in laid}}
    far = F.create_map(*(F.lit(x) for pair in sorted(reach.items()) for x in pair))
    places = F.transform("words", lambda w, i: F.when(w.isin(*reach), i))
    rows = rows.withColumn("places", F.filter(places, lambda i: i.isNotNull())).where("size(places) > 0")

    def around(i: Column) -> Column:
        r = F.element_at(far, F.get("words", i))
        base = F.greatest(i - r, F.lit(0))
        return F.struct(
            (i - base).alias("at"),
            F.get("words", i).alias("word"),
            base.alias("base"),
            F.slice("words", base + 1, 2 * r + 1).alias("near"),
        )

    rows = rows.select("path", "is_file", F.explode(F.transform("places", around)).alias("a")).select("path", "is_file", "a.*")
    shares = templates.groupBy("template").agg(
        F.collect_list(F.struct("term", (F.col("part") * F.col("part")).alias("square"))).alias("shares")
    )
    lay = small_table(spark, laid, "template int, word string, place int, words int").join(shares, "template")
    begin = F.greatest(F.col("at") - F.col("place"), F.lit(0))
    end = F.col("at") - F.col("place") + F.col("words")
    held = F.aggregate(
        "shares", F.lit(0.0), lambda sum_, s: sum_ + F.when(F.array_contains("unit", s["term"]), s["square"]).otherwise(0.0)
    )
    return (
        rows.join(F.broadcast(lay), "word")
        .select("path", "is_file", (F.col("base") + begin).alias("place"), F.slice("near", begin + 1, end - begin).alias("unit"), "shares")
        # The cosine is at most the root of the share of the template that the window holds.
        .where(held >= LEAST * LEAST - 1e-6)
        .select("path", "is_file", "place", F.array_join("unit", " ").alias("unit"), F.size("unit").alias("size"))
    )


def small_table(spark: SparkSession, rows: list[tuple], shape: str) -> DataFrame:
    """Rows made on the driver, as one literal of the plan."""
    names = [field.split()[0] for field in shape.split(", ")]
    text = json.dumps([dict(zip(names, row, strict=True)) for row in rows])
    kind = ", ".join(field.replace(" ", ": ") for field in shape.split(", "))
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{kind}>>")))


def tagged(units: DataFrame) -> DataFrame:
    """(unit_key, license, similarity) of units with an SPDX tag, the first of each."""
    name = F.regexp_extract("unit", SPDX, 1)
    name = F.regexp_replace(name, r"(?i)-only\b|-or-later\b|\+|[.-]+(?=[)\s]|$)", "")
    name = F.when(F.contains(name, F.lit(" ")), name).otherwise(F.regexp_replace(name, "[()]", ""))
    known = F.create_map(*(F.lit(x) for n in sorted({n for n, _ in VARIANTS}) for x in (n.lower(), n)))
    rows = units.where(F.contains(F.lower("unit"), F.lit("spdx-license-identifier"))).withColumn("name", name)
    rows = rows.where("name <> ''").withColumn("license", F.coalesce(F.element_at(known, F.lower("name")), "name"))
    return rows.groupBy("unit_key").agg(F.min("license").alias("license")).withColumn("similarity", F.lit(1.0))


def matched(units: DataFrame, documents: DataFrame, lines: int, counts: dict[str, int]) -> DataFrame:
    """(unit_key, license, similarity) of distinct units that are similar to a template."""
    spark = documents.sparkSession
    idf = small_table(spark, [(t, inverse(counts.get(t, 0), lines)) for t in VOCABULARY], "term string, idf double")
    distinct = units.groupBy("unit_key").agg(F.first("unit").alias("unit"))
    found = (
        distinct.select("unit_key", F.explode(words(F.col("unit"))).alias("term"))
        .groupBy("unit_key", "term")
        .agg(F.count("*").alias("tf"))
        .join(F.broadcast(idf), "term", "left")
        .withColumn("x", F.col("tf") * F.coalesce("idf", F.lit(inverse(0, lines))))
    )
    found = stage(found.select("unit_key", "term", "x"), "unit-terms")
    norms = found.groupBy("unit_key").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))
    dots = (
        found.join(F.broadcast(template_table(documents, lines, counts)), "term")
        .groupBy("unit_key", "template", "license")
        .agg(F.sum(F.col("x") * F.col("part")).alias("dot"))
    )
    cosine = F.round(F.col("dot") / F.col("norm"), 6)
    first = F.min(F.struct((-F.col("similarity")).alias("less"), "license")).alias("best")
    return (
        dots.join(norms, "unit_key")
        .withColumn("similarity", cosine)
        .where(F.col("similarity") >= LEAST)
        .select("unit_key", "license", "similarity")
        .union(tagged(units))
        .groupBy("unit_key")
        .agg(first)
        .select("unit_key", "best.license", (-F.col("best.less")).alias("similarity"))
    )


def is_license_file(path: Column) -> Column:
    return F.coalesce(F.substring_index(path, "/", -1).isin(*FILE_NAMES), F.lit(False))


def directory(path: Column) -> Column:
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan(documents: DataFrame) -> DataFrame:
    """(doc_id, path, license, origin, similarity, license_dir) of ``documents(doc_id, path, text)``.

    ``origin`` is own, inherited or null; ``license_dir`` is the directory inherited from.
    """
    rows = documents.select("doc_id", "path", "text").withColumn("is_file", is_license_file(F.col("path")))
    lines, counts = line_counts(documents)
    read = F.regexp_extract_all(F.regexp_replace(F.lower("text"), ZERO, ""), F.lit(rf"\n|{WORD}"), F.lit(0))
    rows_ = rows.where(F.regexp_like("text", F.lit(TRIGGER))).withColumn("read", read)
    # Words before each line but the first.
    ends = F.filter(F.transform("read", lambda w, i: F.when(w == "\n", i)), lambda i: i.isNotNull())
    first = F.concat(F.array(F.lit(0)), F.transform(ends, lambda end, i: end - i))
    split = F.arrays_zip(first.alias("place"), F.split("text", "\n").alias("unit"))
    pieces = F.filter(split, lambda x: F.regexp_like(x["unit"], F.lit(TRIGGER)))
    whole = F.struct(F.lit(0).alias("place"), F.col("text").alias("unit"))
    pieces = F.when(F.col("is_file"), F.concat(F.array(whole), pieces)).otherwise(pieces)
    units = rows_.select("path", "is_file", F.explode(pieces).alias("u")).select("path", "is_file", "u.place", "u.unit")
    words_ = rows_.select("path", "is_file", F.filter("read", lambda w: w != "\n").alias("words"))
    units = units.withColumn("size", F.size(words(F.col("unit")))).union(windows(words_, template_table(documents, lines, counts)))
    units = units.withColumn("unit_key", F.md5(F.lower("unit").cast("binary"))).distinct()
    units = stage(units, "license-units")
    best = F.min(F.struct((-F.col("similarity")).alias("less"), "place", (-F.col("size")).alias("shorter"), "license")).alias("best")
    own = (
        units.select("path", "is_file", "place", "size", "unit_key")
        .join(matched(units.select("unit_key", "unit"), documents, lines, counts), "unit_key")
        .groupBy("path")
        .agg(best, F.first("is_file").alias("is_file"))
        .select("path", "is_file", "best.license", (-F.col("best.less")).alias("similarity"))
    )
    own = stage(own.where("path is not null"), "own-licenses")
    best = F.min(F.struct((-F.col("similarity")).alias("less"), "license")).alias("best")
    held = (
        own.where("is_file")
        .groupBy(directory(F.col("path")).alias("dir"))
        .agg(best)
        .select("dir", F.col("best.license").alias("dir_license"), (-F.col("best.less")).alias("dir_similarity"))
    )
    files = rows.select("doc_id", "path").join(own.drop("is_file"), "path", "left")
    parts = F.split(directory(F.col("path")), "/")
    above = F.transform(
        F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/")
    )
    bare = files.where("license is null and path is not null").select("path").distinct()
    nearest = (
        bare.select("path", F.posexplode(F.array_distinct(above)).alias("depth", "dir"))
        .join(held, "dir")
        .groupBy("path")
        .agg(F.max(F.struct("depth", "dir", "dir_license", "dir_similarity")).alias("from"))
        .select("path", "from.dir", "from.dir_license", "from.dir_similarity")
    )
    return files.join(nearest, "path", "left").select(
        "doc_id",
        "path",
        F.coalesce("license", "dir_license").alias("license"),
        F.when(F.col("license").isNotNull(), "own").when(F.col("dir_license").isNotNull(), "inherited").alias("origin"),
        F.coalesce("similarity", "dir_similarity").alias("similarity"),
        F.col("dir").alias("license_dir"),
    )


def document_paths(documents: DataFrame) -> DataFrame:
    """Documents with a path from their columns: source, language, thousand, hundred, name.

    The document that begins a thousand or a hundred is the licence file of its directory.
    """
    thousand, hundred = (F.floor(F.col("doc_id") / n).cast("string") for n in (1000, 100))
    levels = [F.coalesce(F.col(c).cast("string"), F.lit("_")) for c in ("source", "lang")]
    path = (
        F.when(F.col("doc_id") % 1000 == 0, F.concat_ws("/", *levels, thousand, F.lit("LICENSE")))
        .when(F.col("doc_id") % 100 == 0, F.concat_ws("/", *levels, thousand, hundred, F.lit("LICENSE")))
        .when(
            F.col("doc_id").isNotNull(),
            F.concat_ws("/", *levels, thousand, hundred, F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))),
        )
    )
    return documents.select("doc_id", "text", path.alias("path"))
