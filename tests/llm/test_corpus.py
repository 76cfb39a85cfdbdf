"""Corpus operators against brute force, and on odd rows."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from propfold.llm import (
    arc_convert,
    importance,
    license_scan,
    line_cleaning,
    mixing,
    near_dedup,
    packing,
    permutation_index,
    repeats,
    texts,
    toxicity,
)

SF = "/root/testdata/sf0.001"
SHAPE = "doc_id long, text string, lang string, source string, n_chars long, score string, spans int"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, ties, and clashing extra columns."""
    base = " ".join(f"w{k}" for k in range(300))
    near = base.replace("w150 ", "changed ")
    long = " ".join(f"long{k % 40000}" for k in range(60000))
    rows = [
        (None, None), (1, None), (2, ""), (3, " \n\t "), (4, "two words"), (5, "TWO words"),
        (6, base), (7, near), (8, base), (8, base), (None, base), (9, long), (10, "é" * 300),
        (11, "ab" * 400), (12, "x y z\x1cq"),
    ]
    return spark.createDataFrame(
        [(i, t, None if i == 4 else "en", "s", None, "x", 1) for i, t in rows], SHAPE
    )


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SHAPE)


def collected(rows):
    return [tuple(r) for r in rows.collect()]


def word_lists(documents):
    return [(r[0], WORD.findall((r[1] or "").encode())) for r in documents.select("doc_id", "text").collect()]


def test_words_and_hashes_agree_with_a_pattern():
    column = pa.array(["a bb\x0bccc", None, "", "x y \x1c z", " lead", "A a"])
    chunk = next(texts.chunks(column))
    found = texts.words(chunk)
    got = [bytes(chunk.data[a:b]) for a, b in zip(found.starts, found.ends, strict=True)]
    assert got == [w for t in column.to_pylist() for w in WORD.findall((t or "").encode())]
    exact, low = texts.word_hashes(chunk, found), texts.word_hashes(chunk, found, lower=True)
    assert exact[-1] != exact[-2] and low[-1] == low[-2] and len(set(exact.tolist())) == len(set(got))


@pytest.mark.parametrize("which", ["given", "odd"])
def test_line_cleaning_counts(request, which):
    documents = request.getfixturevalue(which)
    got = line_cleaning.clean_lines(documents, with_text=False)
    found = Counter(collected(got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")))
    wanted = Counter()
    for doc_id, text in collected(documents.select("doc_id", "text")):
        words = WORD.findall((text or "").encode())
        windows = Counter(zip(words, words[1:], words[2:], strict=False))
        inside = {
            k + d
            for k in range(len(words) - 2)
            if windows[tuple(words[k : k + 3])] > 1
            for d in range(3)
        }
        lines = [x for x in (text or "").split("\n") if WORD.search(x.encode())]
        chars = sum(len(w.decode()) for w in words)
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        wanted[(doc_id, len(words), chars, symbols, len(lines) - len(set(lines)), len(inside))] += 1
    assert found == wanted


def test_line_cleaning_removes_lines(spark):
    prose = "A plain sentence of some words that goes on. " * 12
    text = f"{prose}\nHome | News | Sport | More\nAll rights reserved.\nno end"
    row = line_cleaning.clean_lines(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["clean_text"] == prose and row["n_lines_removed"] == 3
    assert row["base_failed"] and not row["kept"]  # its sentence is repeated


def near_by_force(documents, size):
    rows = [
        (i, frozenset(tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))) if w else frozenset())
        for i, w in ((i, [x.lower() for x in w]) for i, w in word_lists(documents))
    ]
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    at = defaultdict(set)
    for n, (_, s) in enumerate(rows):
        for g in s:
            at[g].add(n)
    for n, (i, s) in enumerate(rows):
        for m, shared in Counter(m for g in s for m in at[g] if m < n).items():
            j, t = rows[m]
            if i is not None and j is not None and 100 * shared >= 80 * (len(s) + len(t) - shared):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [(i, len(s), None if i is None else root(i)) for i, s in rows]


@pytest.mark.parametrize("which", ["given", "odd"])
@pytest.mark.parametrize(("pairs", "size"), [(64, 4), (0, 5)])
def test_near_duplicates(request, monkeypatch, which, pairs, size):
    monkeypatch.setattr(near_dedup, "PAIRS", pairs)
    documents = request.getfixturevalue(which)
    got = near_dedup.near_duplicates(documents, size).where("doc_id is not null")
    wanted = [r for r in near_by_force(documents, size) if r[0] is not None]
    assert Counter(collected(got.select("doc_id", "n_shingles", "component_id"))) == Counter(wanted)
    assert got.where("kept <> (doc_id = component_id)").isEmpty()


def test_near_duplicates_in_blocks(spark, monkeypatch):
    """A family whose members are linked to few others, split into small blocks."""
    monkeypatch.setattr(near_dedup, "PAIRS", 0)
    monkeypatch.setattr(near_dedup, "OUTSIDE", 3)
    monkeypatch.setattr(near_dedup, "MEMBERS", 4)
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for doc_id in range(80):
        words = list(base)
        for k in rng.choice(120, size=int(rng.integers(1, 6)), replace=False):
            words[k] = f"e{doc_id}x{k}"
        rows.append((doc_id, " ".join(words)))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.near_duplicates(documents, 4).select("doc_id", "n_shingles", "component_id")
    assert Counter(collected(got)) == Counter(near_by_force(documents, 4))


def repeats_by_force(documents, size):
    rows = [(i, (t or "").encode()) for i, t in collected(documents.select("doc_id", "text"))]
    seen = Counter(b[k : k + size] for _, b in rows for k in range(len(b) - size + 1))
    out = []
    for i, b in rows:
        flag, last = bytearray(len(b)), 0
        for k in range(len(b) - size + 1):
            if seen[b[k : k + size]] > 1:
                for q in range(max(k, last), k + size):
                    flag[q] = 1
                last = k + size
        spans = sum(1 for k in range(len(b)) if flag[k] and not (k and flag[k - 1]))
        kept = bytes(c for c, f in zip(b, flag, strict=True) if not f)
        out.append((i, len(b), sum(flag), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("which", ["given", "odd"])
@pytest.mark.parametrize("group", [30_000, 1])
def test_repeats(request, monkeypatch, which, group):
    """Both ways of an anchor: sorted in a task, and counted by hash."""
    monkeypatch.setattr(repeats, "GROUP", group)
    documents = request.getfixturevalue(which)
    if which == "odd":
        documents = documents.where("doc_id is null or doc_id <> 9")  # brute force is slow on it
    assert Counter(collected(repeats.repeat_digest(documents))) == Counter(repeats_by_force(documents, 200))


def test_repeats_in_periodic_and_split_texts(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PIECE", 2000)
    rng = np.random.default_rng(3)
    noise = ["".join(rng.choice(list("abcdefgh "), 900)) for _ in range(8)]
    rows = ["a" * 3000, "ab" * 900, noise[0] + noise[1][:400], noise[2] + noise[1][100:700], noise[3] * 2, *noise[4:]]
    documents = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert Counter(collected(repeats.repeat_digest(documents))) == Counter(repeats_by_force(documents, 200))


def test_repeats_of_rows_without_id_whose_texts_share_a_32_bit_hash(spark):
    def text(k):
        return "".join(hashlib.sha512(f"{k}{c}".encode()).hexdigest() for c in "abc")

    one, other = 83668, 243672
    rows = [(None, text(one)), (None, text(other)), (None, text(one)[:250] + "x" * 50), (None, "y" * 150)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    assert documents.limit(2).select(F.hash("text").alias("h")).distinct().count() == 1
    assert Counter(collected(repeats.repeat_digest(documents))) == Counter(repeats_by_force(documents, 200))


def test_spans_of_repeated_rows_are_taken_once(spark):
    """Forty rows of one id and forty without: as many spans as of one row."""
    rng = np.random.default_rng(4)
    parts = ["".join(rng.choice(list("abcdefgh "), 400)) for _ in range(4)]
    rows = [(k, t) for k, t in [(1, parts[0] + parts[1]), (None, parts[2] + parts[1])] for _ in range(40)]
    documents = spark.createDataFrame([*rows, (2, parts[3] + parts[1][50:350])], "doc_id long, text string")
    spans = [[tuple(x) for x in r["spans"]] for r in repeats.repeated_spans(documents).collect()]
    assert len(spans) == 3 and all(len(x) == len(set(x)) < 40 for x in spans)
    assert Counter(collected(repeats.repeat_digest(documents))) == Counter(repeats_by_force(documents, 200))


def test_removing_repeats_keeps_characters_and_columns(odd):
    got = repeats.without_repeats(odd)
    assert got.columns == odd.columns and got.count() == odd.count()
    kept = {r["doc_id"]: r["text"] for r in got.where("doc_id in (4, 10)").collect()}
    assert kept[4] == "two words" and set(kept[10]) <= {"é"}


def test_permutation_index_recall(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    got = defaultdict(dict)
    for r in permutation_index.nearest(rows, F.col("vec_id") % 100 == 0).collect():
        got[r["query_id"]][r["rank"]] = r["vec_id"], r["score"]
    table = rows.toPandas().sort_values("vec_id")
    ids, x = table["vec_id"].to_numpy(), np.stack(table["embedding"]).astype(float)
    hits = 0
    for q in ids[ids % 100 == 0]:
        far = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
        far[ids == q] = np.inf
        hits += len(set(ids[np.lexsort((ids, far))[:10]]) & {v for v, _ in got[q].values()})
        assert sorted(got[q]) == list(range(1, 11))
        assert all(np.isclose(far[ids == v], d) for v, d in got[q].values())
    assert hits >= 0.9 * 10 * len(got)


def recall(rows, found):
    ids, x = rows
    hits = total = 0
    for q in ids[ids % 100 == 0]:
        far = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
        far[ids == q] = np.inf
        hits += len(set(ids[np.lexsort((ids, far))[:10]]) & found[q])
        total += 10
    return hits / total


@pytest.mark.parametrize("grouped", [False, True])
def test_permutation_index_visits_some_shards_only(spark, grouped):
    """Many shards and blocks: recall holds, and vectors in groups go to few of the blocks."""
    if grouped:
        pick = np.random.default_rng(4)
        x = pick.normal(size=(24, 32))[pick.integers(0, 24, 4000)] * 4 + pick.normal(size=(4000, 32))
        x[1000:2400] = x[7]  # a third of all rows are copies of one
        ids = np.arange(4000)
        rows = spark.createDataFrame(list(zip(ids.tolist(), x.tolist(), strict=True)), "vec_id long, embedding array<double>")
    else:
        rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
        table = rows.toPandas().sort_values("vec_id")
        ids, x = table["vec_id"].to_numpy(), np.stack(table["embedding"]).astype(float)
    query = F.col("vec_id") % 100 == 0
    vectors = permutation_index.usable(rows)
    pivots = permutation_index.choose_pivots(vectors)
    indexed = permutation_index.index(vectors, pivots).cache()
    held, asked = permutation_index.planned(indexed, query, pivots, 10, 0.97, 100, 5)
    shards = held.select("shard").distinct().count()
    blocks = asked.select("block").distinct().count()
    assert shards >= 4 and blocks >= 4
    assert held.groupBy("shard", "block").count().agg(F.max("count")).first()[0] <= 200
    visited = asked.count() / (asked.select("vec_id").distinct().count() * shards)
    moved = held.count() / (len(ids) * blocks)
    if grouped:  # the given vectors have no groups, so they need nearly all shards
        assert visited < 0.5 and moved < 0.5
    found = defaultdict(set)
    for r in permutation_index.nearest(rows, query, shard=100, queries=5).collect():
        found[r["query_id"]].add(r["vec_id"])
    assert recall((ids, x), found) >= 0.9


def test_cells_are_dealt_to_portions():
    found = permutation_index.portions({0: 5, 1: 30, 2: 4, 3: 4, 4: 4}, [2, 0, 3, 1, 4], 10)
    assert found == [(0, 1), (2, 3), (0, 1), (1, 1), (5, 1)]


def test_permutation_index_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (100, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [0.0, 1.0])]
    rows += [(5, None), (6, [0.0, 0.0]), (7, [float("nan"), 1.0]), (8, [None, 1.0]), (9, [1.0]), (None, [1.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(collected(permutation_index.nearest(vectors, F.col("vec_id") % 100 == 0)))
    assert [r[:3] for r in got] == [(0, 1, 100), (0, 2, 3), (0, 3, 4), (100, 1, 0), (100, 2, 3), (100, 3, 4)]
    assert permutation_index.nearest(vectors.where("vec_id < 0"), F.lit(True)).count() == 0


def test_toxicity_learns_and_is_repeatable(spark):
    documents = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = toxicity.fit(documents, labels.where(~toxicity.held_out(F.col("doc_id"))))
    assert 0 < len(model.index) < 5000
    rows = toxicity.score(documents, model).join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id")))
    found = {r["toxic"]: r["share"] for r in rows.groupBy("toxic").agg(F.avg((F.col("score") >= 0.7).cast("int")).alias("share")).collect()}
    assert found[1] > 0.5 and found[0] < 0.01


def test_importance_keeps_the_target_and_the_share(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = importance.resample(documents, labels.where("quality = 1")).cache()
    assert got.where("kept").count() == 860
    share = got.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("s"))
    share = {r["quality"]: r["s"] for r in share.collect()}
    assert share[1] > 0.95 and share[0] < 0.1


def test_importance_keeps_the_share_that_the_labels_have(spark, tmp_path):
    """A third of the rows is poor: they go, and no clean one does."""
    from propfold.llm import queries

    rng = np.random.default_rng(6)
    words = {q: [f"{'good' if q else 'junk'}{k}" for k in range(200)] for q in (0, 1)}
    quality = [int(k % 3 != 0) for k in range(900)]
    rows = [(k, " ".join(rng.choice(words[q], 40))) for k, q in enumerate(quality)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = spark.createDataFrame(list(enumerate(quality))[:300], "doc_id long, quality int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op2_importance_resampling(spark, str(tmp_path)).where("kept").select("doc_id")
    assert {r[0] for r in got.collect()} == {k for k, q in enumerate(quality) if q}


def test_kth_largest(spark):
    rng = np.random.default_rng(1)
    values = np.round(rng.normal(size=20_000), 3)
    rows = spark.createDataFrame([(float(v),) for v in values], "x double")
    for k in (1, 7, 5000, 20_000):
        assert importance.kth_largest(rows, "x", k) == np.sort(values)[-k]


def test_packing_places_every_token_once(odd):
    sizes = (16, 64, 256)
    items = packing.document_items(odd)
    got = packing.pack(items, sizes).collect()
    assert sum(r["length"] for r in got) == items.agg(F.sum("length")).first()[0]
    bins = defaultdict(list)
    for r in got:
        bins[r["bin_id"]].append(r)
    for rows in bins.values():
        end = 0
        for r in sorted(rows, key=lambda r: r["bin_offset"]):
            assert r["bin_offset"] == end
            end += r["length"]
        used, size = rows[0]["bin_used"], rows[0]["bin_size"]
        assert end == used <= size and size == min(s for s in sizes if s >= used)


def test_arc_round_trip_with_revisits(spark):
    big, small = "<p>" + "ä" * 800 + "</p>", "<p>small</p>"
    rows = [(1, "http://a/ b", big), (2, None, big), (7, "http://c/", big), (3, "u", small), (4, "u", small)]
    rows += [(5, "u", None), (6, "u", ""), (None, "u", big), (8, "u", "WARC/1.0\r\n\r\nfiledesc://x 0 0 0 9\n" * 50), (9, "u", "a\n\r\n\r\n"), (9, "u", "a\n\r\n\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = Counter(collected(arc_convert.round_trip(pages)))
    wanted = Counter()
    for page, _, html in rows:
        body = (html or "").encode()
        again = page in (1, 2)
        wanted[(page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", 7 if again else None)] += 1
    assert got == wanted
    assert arc_convert.round_trip(pages.limit(0)).count() == 0


def test_arc_pages_with_the_url_of_a_version_block(spark):
    rows = [(1, "http://a/", "<p>one</p>"), (2, "filedesc://x.arc", "<p>\nURL Other-field\n</p>"), (3, "http://b/", "<p>two</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = Counter(collected(arc_convert.round_trip(pages).select("page_id", "payload_digest")))
    assert got == Counter((page, hashlib.sha1(html.encode()).hexdigest()) for page, _, html in rows)


def test_arc_versions_are_parsed_by_their_own_lines():
    one = b"filedesc://x.arc 0.0.0.0 19990101 text/plain 74\n1 0 org\nURL IP-address Archive-date Content-type Archive-length\n"
    head = one.split(b"\n", 1)[0].rsplit(b" ", 1)[0]
    body = one.split(b"\n", 1)[1]
    data = head + b" %d\n" % len(body) + body + b"\nhttp://u/ 1.2.3.4 19990203040506 text/html 5\nab\ncd\n"
    records = list(arc_convert.parse_arc(data))
    assert records[1].block == b"ab\ncd" and records[1].fields["ip-address"] == "1.2.3.4"
    assert arc_convert.warc_date("19990203040506") == "1999-02-03T04:05:06Z"
    assert arc_convert.warc_date("19990203") == "1999-02-03T00:00:00Z"
    with pytest.raises(ValueError):
        list(arc_convert.parse_arc(b"http://u/ 1.2.3.4 19990203040506 text/html 50\nab"))


def test_mixing_meets_the_marginals(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    cells = mixing.cell_table(mixing.described(documents))
    raked = mixing.rake(cells, {"lang": mixing.LANGUAGES}, mixing.POWERS, 20, 1)
    total = raked.agg(F.sum("weight")).first()[0]
    assert abs(total - 1) < 1e-9
    for r in raked.groupBy("lang").agg(F.sum("weight").alias("w")).collect():
        assert abs(r["w"] - mixing.LANGUAGES[r["lang"]]) < 0.01
    first, again = (mixing.mix(documents).where("mix_kept").count() for _ in range(2))
    assert first == again > 0


def test_mixing_rates_meet_the_marginals_of_a_skewed_table(spark, caplog):
    """Marginals of the tokens that the rates keep, nine tenths of them English."""
    rng = np.random.default_rng(2)
    rows = []
    for k in range(3000):
        lang = "en" if rng.random() < 0.92 else str(rng.choice(["de", "fr", "es"]))
        source = "hot" if rng.random() < 0.4 else f"s{int(rng.integers(6))}"
        mark = "@" if rng.random() < (0.4 if lang == "en" else 0.1) else ""
        rows.append((k, f"{mark}word " * int(rng.integers(5, 60)), lang, source))
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = mixing.mix(documents).cache()
    part = F.sum(F.col("mix_tokens") * F.col("mix_rate"))
    whole = out.agg(part).first()[0]
    langs = {r[0]: r[1] / whole for r in out.groupBy("mix_lang").agg(part).collect()}
    assert all(abs(langs[k] - v) < 1e-4 for k, v in mixing.LANGUAGES.items())
    sums = {r[0]: r[1] ** 0.7 for r in out.groupBy("mix_source").agg(F.sum("mix_tokens")).collect()}
    sources = {r[0]: r[1] / whole for r in out.groupBy("mix_source").agg(part).collect()}
    assert all(abs(sources[k] - v / sum(sums.values())) < 1e-4 for k, v in sums.items())
    # No larger budget would do: the fullest cell is kept whole.
    assert out.agg(F.max("mix_rate")).first()[0] == pytest.approx(1.0, abs=1e-6)
    assert "budget lowered" in caplog.text
    kept = {r[0]: r[1] for r in out.where("mix_kept").groupBy("mix_lang").agg(F.sum("mix_tokens")).collect()}
    assert all(abs(kept[k] / sum(kept.values()) - v) < 0.06 for k, v in mixing.LANGUAGES.items())


def test_raking_of_many_cells_equals_that_of_few(given):
    cells = mixing.cell_table(mixing.described(given))
    few, many = (
        {
            (r["source"], r["lang"], r["topic"]): r["weight"]
            for r in mixing.rake(cells, {"lang": mixing.LANGUAGES}, mixing.POWERS, 2, count).collect()
        }
        for count in (1, mixing.FEW_CELLS + 1)
    )
    assert few.keys() == many.keys() and few
    assert all(abs(many[k] - w) <= 1e-9 * abs(w) + 1e-12 for k, w in few.items())


def test_license_inheritance(spark):
    mit, gpl = license_scan.TEMPLATES["MIT"], license_scan.TEMPLATES["GPL-3.0"]
    rows = [
        (1, "a/LICENSE", f"Some words.\n{mit}"), (2, "a/b/c/x.txt", "No notice."), (3, "a/b/LICENSE", gpl),
        (4, "a/b/y.txt", f"{mit}\nText."), (5, "z/x.txt", "Nothing."), (6, None, mit), (7, "a/n.txt", None),
        (8, "ab/n.txt", ""), (2, "a/b/c/x.txt", "No notice."),
    ]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()
    found = {r["doc_id"]: (r["license"], r["origin"], r["license_dir"]) for r in got}
    assert len(got) == len(rows)
    assert found[1] == ("MIT", "own", None) and found[3] == ("GPL-3.0", "own", None)
    assert found[2] == ("GPL-3.0", "inherited", "a/b") and found[7] == ("MIT", "inherited", "a")
    assert found[4] == ("MIT", "own", None) and found[5][0] is found[6][0] is found[8][0] is None


def test_license_headers_files_and_tags(spark):
    """Real headers on one line each, whole LICENSE files, and SPDX tags."""
    whole = dict(license_scan.license_texts.whole())
    mit = next(t for n, t in license_scan.license_texts.texts() if n == "MIT" and "WITHOUT WARRANTY" in t)
    gpl = (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    )
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
    agpl = gpl.replace("General", "Affero General")
    wanted = {
        "a/x.py": ("# SPDX-License-Identifier: MIT", "MIT"),
        "a/y.py": ("/* SPDX-License-Identifier: Apache-2.0 */\ncode", "Apache-2.0"),
        "a/z.c": ("code\n// SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0"),
        "a/e.c": ("// SPDX-License-Identifier: (MIT OR Apache-2.0)", "(MIT OR Apache-2.0)"),
        "a/prose": ("An SPDX-License-Identifier: tag is short.", None),
        "b/gpl.c": (gpl, "GPL-3.0"),
        "b/gpl2.c": (gpl.replace("version 3", "version 2"), "GPL-2.0"),
        "b/agpl.c": (agpl, "AGPL-3.0"),
        "b/mpl.c": (mpl, "MPL-2.0"),
        "b/title.txt": ("Apache License", "Apache-2.0"),
        "b/nd.txt": ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0"),
        "c/LICENSE": (f"Copyright (c) 2020 A. Person\n\n{mit}", "MIT"),
        **{f"d{k}/LICENSE": (text, name) for k, (name, text) in enumerate(whole.items())},
    }
    rows = [(k, path, text) for k, (path, (text, _)) in enumerate(wanted.items())]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()
    assert {r["path"]: r["license"] for r in got} == {path: name for path, (_, name) in wanted.items()}


def test_license_notices_across_and_within_lines(spark):
    apache, gpl = license_scan.TEMPLATES["Apache-2.0"], license_scan.TEMPLATES["GPL-2.0"]
    texts_ = dict(license_scan.license_texts.whole())
    words = "some plain words that go on and say nothing of use ".split()
    wrapped = "\n".join(f" * {line}" for line in re.findall(r".{1,60}(?:\s|$)", dict(license_scan.VARIANTS)["ISC"]))
    wanted = {
        "a/wrapped.c": (gpl.replace("Public ", "Public\n"), "GPL-2.0"),
        "a/isc.c": (f"/*\n{wrapped}\n */\nint main;", "ISC"),
        "a/gpl.txt": (f"Our code\n\n{texts_['GPL-3.0']}", "GPL-3.0"),
        **{f"b/{n}.txt": (" ".join([*(words * 6)[:n], apache, *words]), "Apache-2.0") for n in (8, 20, 50)},
        # The earlier of two notices.
        "b/two.txt": (f"{apache} {' '.join(words)}\n\n{gpl}", "Apache-2.0"),
        "b/two_wrapped.txt": (f"{gpl.replace('Public ', 'Public' + chr(10))}\n{apache}", "GPL-2.0"),
        "b/none.txt": ("A driver has to show the license at the gate, with permission of the public. " * 9, None),
    }
    rows = [(k, path, text) for k, (path, (text, _)) in enumerate(wanted.items())]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, path string, text string")).collect()
    assert {r["path"]: r["license"] for r in got} == {path: name for path, (_, name) in wanted.items()}


def test_empty_and_odd_tables_pass_all_operators(spark, empty, odd):
    labels = spark.createDataFrame([(4, 1), (6, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    for documents in (empty, odd):
        n = documents.count()
        paths = license_scan.document_paths(documents)
        model = toxicity.fit(documents, labels)
        for rows in (
            license_scan.scan(paths),
            importance.resample(documents, labels.where("toxic = 0")),
            line_cleaning.clean_lines(documents),
            toxicity.score(documents, model),
            near_dedup.near_duplicates(documents),
            repeats.repeat_digest(documents),
            mixing.mix(documents),
        ):
            assert rows.count() == n
        assert packing.pack(packing.document_items(documents)).count() >= n


def test_pipeline_on_odd_rows(spark, odd, tmp_path):
    import corpus_pipeline

    odd.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(4, 1), (6, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, rows, str(tmp_path))
        if name != "packing":
            assert out.columns == odd.columns
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        rows = spark.read.parquet(path)
    assert rows.count() > 0
