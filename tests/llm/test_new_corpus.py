"""Language identification, fill-in-middle and collocations: brute force and odd rows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from propfold.llm import arc_convert, collocations, fill_middle, importance, language_id, packing, queries

SF = "/root/testdata/sf0.001"
SHAPE = "doc_id long, text string, lang string, source string, n long, form string, score string, part int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 7, "x", "y", 1) for i, t, lang in rows], SHAPE)


@pytest.fixture(scope="module")
def odd(spark):
    base = "Ein Wort, zwei Wörter und noch ein Wort. " * 40
    rows = [
        (None, None, None), (1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, "a", "en"),
        (5, base, "de"), (5, base, "de"), (None, base, "de"), (6, base * 400, "de"), (7, "é<P>x", "fr"),
        (8, "<", "fr"), (9, "<P" * 50, "fr"), (10, "🙂" * 70000, "xx"), (11, "1 2 3 4 !", "en"), (12, "A a. A\ta A", "en"),
        (13, "the end " * 31, None), (14, "Straße\x0bÉtÉ" * 30, "fr"),
    ]
    return table(spark, rows)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SHAPE)


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def collected(rows):
    return [tuple(r) for r in rows.collect()]


# Fill-in-middle


def fim_by_force(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        form, out = "plain", text
    elif h4 % 100 < 20:
        form, out = "spm", f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    else:
        form, out = "psm", f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"
    cuts = (None, None) if form == "plain" else (a, b - a)
    return (n, form, *cuts, out)


@pytest.mark.parametrize("which", ["given", "odd", "empty"])
def test_fill_in_middle(request, which):
    documents = request.getfixturevalue(which)
    wanted = Counter()
    for doc_id, text in collected(documents.select("doc_id", "text")):
        n, form, prefix, middle, out = fim_by_force(doc_id, text)
        digest = hashlib.sha256(out.encode()).hexdigest()
        whole = hashlib.sha256((text or "").encode()).hexdigest()
        wanted[(doc_id, n, form, prefix, middle, digest, whole)] += 1
    got = fill_middle.fill_in_middle_digest(documents)
    assert Counter(collected(got)) == wanted
    made = fill_middle.fill_in_middle(documents)
    texts = Counter(collected(made.select("document.doc_id", "n", "form", "prefix_chars", "middle_chars", "output")))
    forced = Counter((i, *fim_by_force(i, t)) for i, t in collected(documents.select("doc_id", "text")))
    assert texts == forced
    assert made.select("document.*").columns == [c for c in documents.columns if c != "text"]


def test_frames_are_cut_between_code_points():
    packer, unpacker = zstandard.ZstdCompressor(), zstandard.ZstdDecompressor()
    draw = random.Random(1)
    for size in (4, 7, 64):
        text = "".join(draw.choice("aé€🙂<PSM>") for _ in range(draw.randrange(1, 300)))
        writer = fill_middle.FrameWriter(packer, size)
        data = text.encode()
        for at in range(0, len(data), 5):
            writer.write(data[at : at + 5])
        frames = writer.close()
        assert frames.units == len(text)
        for blob in frames.blobs:
            assert len(unpacker.decompress(blob)) <= size
            unpacker.decompress(blob).decode()
        for _ in range(50):
            a, b = sorted(draw.randrange(len(text) + 1) for _ in range(2))
            assert b"".join(fill_middle.read_units(frames, a, b, unpacker)).decode() == text[a:b]
            for mark in fill_middle.MARKS:
                assert fill_middle.find_mark(frames, mark, a, unpacker) == text.find(mark.decode(), a)


def test_only_cut_frames_are_decompressed():
    class Counting:
        def __init__(self):
            self.calls, self.unpacker = 0, zstandard.ZstdDecompressor()

        def decompress(self, blob):
            self.calls += 1
            return self.unpacker.decompress(blob)

    writer = fill_middle.FrameWriter(zstandard.ZstdCompressor(), 100)
    writer.write(b"x" * 10_000)
    frames, counting = writer.close(), Counting()
    assert b"".join(fill_middle.read_units(frames, 4_950, 5_050, counting)) == b"x" * 100
    assert counting.calls == 2


# Collocations


def phrases_by_force(documents, least=30, top=2000):
    f, n = defaultdict(Counter), Counter()
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    for lang, text in documents:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                f[lang].update(tuple(words[k : k + size]) for k in range(len(words) - size + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        gone = set()
        for p, a in candidates.items():
            for size in range(2, len(p)):
                for k in range(len(p) - size + 1):
                    part = p[k : k + size]
                    if 100 * a >= 80 * candidates[part]:
                        gone.add(part)
        rows = []
        for p, a in candidates.items():
            if p not in gone:
                cuts = [(2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
                score, k = min(cuts)
                rows.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


@pytest.mark.parametrize("which", ["given", "odd", "empty"])
def test_collocations(request, which):
    documents = request.getfixturevalue(which)
    wanted = phrases_by_force(collected(documents.select("lang", "text")))
    got = collected(collocations.top_phrases(documents))
    assert sorted(got) == sorted(wanted)
    assert which == "empty" or wanted


def test_collocations_where_the_filter_marks_nearly_everything(spark):
    draw = random.Random(3)
    rows = [
        (k, " ".join(draw.choices(["a", "b", "C", "dé", "e,", "f."], [9, 5, 3, 2, 1, 1], k=300)), draw.choice(["x", None]))
        for k in range(60)
    ]
    rows += [(100, "hot word " * 3000, "x")] * 2
    documents = table(spark, rows)
    wanted = sorted(phrases_by_force(collected(documents.select("lang", "text")), top=40))
    assert sorted(collected(collocations.top_phrases(documents, 40))) == wanted
    assert sorted(collected(collocations.top_phrases(documents, 40, filter_bits=64))) == wanted


def test_filters_miss_no_frequent_run(spark, given):
    """Runs of up to three words that occur often enough are marked, and few others are."""
    rows = given.select("lang", "text")
    filters, _ = collocations.run_filters(rows)
    counts = Counter()
    for lang, text in collected(rows):
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            counts.update((lang, *words[k : k + size]) for size in (1, 2, 3) for k in range(len(words) - size + 1))
    for size in (1, 2, 3):
        some = [(p, a) for p, a in counts.items() if len(p) == size + 1]
        columns = [collocations.array_hashes(pa.array([p[k] for p, _ in some])) for k in range(size + 1)]
        hashes = columns[0]
        for column in columns[1:]:
            hashes = collocations.chained(hashes, column)
        often = np.array([a >= collocations.LEAST for _, a in some])
        found = collocations.marked(filters[size - 1].frequent, hashes)
        assert often.any() and found[often].all() and found[~often].mean() < 0.01


def test_counters_take_many_occurrences():
    chunk = pa.RecordBatch.from_pydict({"lang": ["en"], "text": ["word " * 1000 + "other " * 255 + "rare"]})
    (words,) = collocations.counted(chunk)
    batch = collocations.key_counts(words, [])
    order = pa.compute.sort_indices(batch.column("group"))
    (key_batches,) = ([*collocations.reached(iter([batch.take(order)]))],)
    assert sum(b.num_rows for b in key_batches) == 2


def test_stripes_hold_prefixes_and_their_extensions(spark):
    documents = table(spark, [(1, "a b a b c. a b " * 40, "x"), (2, "a", "x")])
    stripes = collocations.stripes_of(documents)
    rows = stripes.select("prefix", F.inline(F.arrays_zip("words", "counts")))
    found = {(prefix, word): n for prefix, word, n in collected(rows)}
    assert found["", "a"] == 121 and found["a", "b"] == 120 and found["a b", "a"] == 79
    assert sum(n for (prefix, _), n in found.items() if not prefix) == 281


# Language identification


def test_backpropagation_agrees_with_differences():
    draw = np.random.default_rng(0)
    model = language_id.start(("a", "b", "c"), 4, 1)
    model = model._replace(**{k: getattr(model, k).astype(float) for k in ("inputs", "states", "output", "bias")})
    codes, label = draw.integers(0, 5, (7, 3)), np.array([0, 2, 1])
    codes[5:, 1] = language_id.PAD

    def loss():
        p = np.stack(list(language_id.window_probabilities(model, codes)))
        real = codes != language_id.PAD
        return -np.log(p[:, label, np.arange(3)][real]).mean()

    for weight, slope in zip(model[1:], language_id.gradients(model, codes, label), strict=True):
        for _ in range(15):
            at = tuple(draw.integers(0, s) for s in weight.shape)
            if weight is model.inputs:
                at = (*at[:2], draw.integers(0, 5))
            old = weight[at]
            weight[at] = old + 1e-5
            up = loss()
            weight[at] = old - 1e-5
            down = loss()
            weight[at] = old
            assert abs((up - down) / 2e-5 - slope[at]) < 1e-7


def test_pooling_does_not_depend_on_neighbours_or_padding():
    model = language_id.start(("a", "b"), 6, 2)
    column = pa.array(["x" * 64, "some text " * 31, "", "é", "some text " * 31])
    alone = np.concatenate([language_id.pooled(model, column[k : k + 1]) for k in range(5)])
    together = language_id.pooled(model, column)
    assert np.allclose(alone, together, atol=1e-6)
    assert (together[1] == together[4]).all() and (together[2] == 0).all()
    assert np.allclose(together[[0, 1, 3]].sum(axis=1), 1, atol=1e-5)


def test_language_on_held_out_rows(spark, given):
    rows = queries.op11_language_id(spark, "/root/testdata/sf0.01")
    assert rows.columns == ["doc_id", "held_out", "lang_pred", "score"]
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = rows.join(documents, "doc_id").where("held_out and lang is not null and lang_pred <> 'und'")
    right, total = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert total > 100 and right > 0.95
    assert rows.count() == documents.count()
    assert rows.where("score < 0 or score > 1 or score is null").isEmpty()


def test_language_odd_rows(spark, odd, empty, given):
    model = language_id.fit(given)
    got = collected(language_id.predict(odd, model).select("document.doc_id", "lang_pred", "score"))
    assert len(got) == odd.count()
    assert {lang for i, lang, _ in got if i in (1, 2, 3, 10, 11)} == {"und"}
    assert len({(lang, s) for i, lang, s in got if i == 5}) == 1
    assert {lang for i, lang, _ in got if i in (5, 6, 14)} <= {"de", "en", "es", "fr"}
    assert language_id.predict(empty, model).isEmpty()
    again = language_id.fit(given)
    assert all((a == b).all() for a, b in zip(model[1:], again[1:], strict=True))
    clash = language_id.predict(odd, model, ["doc_id", "score", "lang"]).select("document.score", "score")
    assert clash.count() == odd.count()


def test_language_with_few_languages(spark, odd, empty):
    none = language_id.fit(empty)
    assert {r[0] for r in collected(language_id.predict(odd, none).select("lang_pred"))} == {"und"}
    one = language_id.fit(odd.where("lang = 'de'"))
    got = collected(language_id.predict(odd, one).select("document.doc_id", "lang_pred", "score"))
    assert {(lang, s) for i, lang, s in got if i in (4, 5)} == {("de", 1.0)}


def test_language_fit_takes_a_bounded_sample(spark):
    rows = [(1, "gleicher Text überall", "de")] * 5000
    rows += [(k, f"the text {k} over there", "en") for k in range(3000)]
    rows += [(k, f"noch ein Text, Nummer {k}", "de") for k in range(3000, 6000)]
    rows += [(6000, "one only", "xx")]
    documents = table(spark, rows)
    model = language_id.fit(documents, fit_rows=400, languages=2)
    assert model.langs == ("de", "en")
    got = language_id.predict(documents.where("lang <> 'xx'"), model, ["lang"])
    assert got.where("document.lang <> lang_pred").count() < 80


def test_language_spans(spark, given):
    model = language_id.fit(given)
    german, french = (
        given.where(f"lang = '{lang}'").orderBy(F.length("text").desc()).first()["text"][:400] for lang in ("de", "fr")
    )
    text = german + " " + french
    rows = spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id long, text string")
    found = {r["document"]["doc_id"]: r["spans"] for r in language_id.spans(rows, model).collect()}
    assert found[2] == found[3] == []
    assert found[1][0]["begin"] == 0 and found[1][-1]["end"] == len(text.encode())
    share = {"de": 0, "fr": 0, "en": 0, "es": 0}
    for span in found[1]:
        share[span["lang"]] += span["end"] - span["begin"]
    assert min(share["de"], share["fr"]) > 0.3 * len(text.encode())
    assert all(a["end"] == b["begin"] and a["lang"] != b["lang"] for a, b in zip(found[1], found[1][1:], strict=False))


# Earlier operators: exact numbers of rows, bounded shards, archives of others


def test_importance_keeps_exactly_the_share(spark):
    rows = [(None if k % 3 == 0 else k, "" if k % 10 < 3 else f"some words {k % 7} of text {k}") for k in range(1000)]
    rows += [(5000, "the same text")] * 100
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([(k,) for k in range(1, 1000, 2)], "doc_id long")
    for share in (0.86, 0.5, 0.05, 1.0, 0.0):
        got = importance.resample(documents, target, share)
        assert got.columns == ["doc_id", "n_grams", "log_weight", "draw", "kept"]
        assert got.where("kept").count() == int(np.ceil(share * len(rows) - 1e-9))
        kept, left = (got.where(c).agg(F.min("draw"), F.max("draw")).first() for c in ("kept", "not kept"))
        if 0 < share < 1:
            assert kept[0] >= left[1]
        if share <= 0.5:
            assert got.where("kept and n_grams = 0").isEmpty()


def test_importance_draws_for_each_row_without_an_id(spark):
    documents = spark.createDataFrame([(None, f"text number {k}") for k in range(500)], "doc_id long, text string")
    weights = importance.log_weights(documents, np.zeros(importance.BUCKETS))
    assert weights.select("noise").distinct().count() == 500


def test_importance_agrees_with_numpy(spark, given):
    target = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1")
    got = importance.resample(given, target, 0.7).toPandas()
    order = got.sort_values("draw", ascending=False)
    assert set(order.head(int(np.ceil(0.7 * len(got))))["doc_id"]) == set(got[got.kept]["doc_id"])


def test_packing_deals_repeated_rows_to_bounded_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 2000)
    items = spark.range(12000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(1).cast("long").alias("length"))
    got = packing.pack(items)
    shards = [r["count"] for r in got.groupBy(F.shiftright("bin_id", 32).alias("shard")).count().collect()]
    assert sum(shards) == 12000 and len(shards) >= 3 and max(shards) < 3000


def least_cost(lengths, sizes):
    """Least total cost over all ways to put the items into bins."""
    bins, best = [], [float("inf")]

    def place(k):
        total = sum(packing.cost(min(s for s in sizes if s >= b)) for b in bins)
        if total >= best[0]:
            return
        if k == len(lengths):
            best[0] = total
            return
        for at in range(len(bins)):
            if bins[at] + lengths[k] <= max(sizes):
                bins[at] += lengths[k]
                place(k + 1)
                bins[at] -= lengths[k]
        bins.append(lengths[k])
        place(k + 1)
        bins.pop()

    place(0)
    return best[0]


def test_packing_is_near_the_least_cost():
    draw, ratios, better = random.Random(5), [], 0
    sizes = (64, 128, 256, 512)
    for _ in range(60):
        lengths = np.array(sorted((draw.randrange(1, 400) for _ in range(7)), reverse=True))

        def total(floor, lengths=lengths):
            used = packing.best_fit(lengths, sizes, floor)[2]
            return sum(packing.cost(min(s for s in sizes if s >= u)) for u in used)

        by_floor = min(total(floor) for floor in sizes)
        found = min(by_floor, total(None))
        better += found < by_floor
        ratios.append(found / least_cost(lengths.tolist(), sizes))
    assert min(ratios) >= 1 - 1e-9 and np.mean(ratios) < 1.05 and max(ratios) < 1.35
    assert better > 0  # the trial fillings choose what no floor does


def test_archives_of_others(spark, tmp_path):
    latin = "Größe".encode("latin-1") + bytes(range(256)) * 5
    records = [
        ("http://a.example/one two", b"HTTP/1.0 200 OK\nContent-Type: text/html\nX-Page-Id: 1\n\n" + latin),
        ("http://b.example/", b"HTTP/1.1 200 OK\r\nX-Page-Id: 2\r\nContent-Length: 1285\r\n\r\n" + latin),
        ("http://c.example/", b"\x00\xff binary"),
    ]
    body = arc_convert.version_block(1, "x.arc").encode()
    for k, (url, block) in enumerate(records):
        body += f"{url} 1.2.3.4 20010203040506 text/html {len(block)}\n".encode() + block + b"\n"
        if not k:
            body += b"http://broken.example/ 1.2.3.4 20010203040506 text/html twelve\nlost bytes\n"
            body += b"http://short.example/ 1.2.3.4 20010203040506 text/html 3\nmore than three\n"
    arcs, warcs = tmp_path / "arc", tmp_path / "warc"
    arcs.mkdir()
    (arcs / "part-0.arc").write_bytes(body)
    arc_convert.convert(spark, str(arcs), str(warcs))
    found = []
    for path in warcs.glob("part-*"):
        found += arc_convert.parse_warc(arc_convert.unpacked(path.read_bytes()))
    kinds = Counter(r.fields["warc-type"] for r in found)
    assert kinds == {"warcinfo": 1, "response": 1, "revisit": 1, "resource": 1}
    urls = {r.fields.get("warc-target-uri"): r for r in found}
    assert urls["http://c.example/"].block == records[2][1]
    response = urls["http://b.example/"]
    assert arc_convert.http_payload(response.block).body == latin
    digest = hashlib.sha1(latin).digest()
    for url in ("http://a.example/one two", "http://b.example/"):
        given = urls[url].fields["warc-payload-digest"]
        assert given == arc_convert.sha1(latin) and digest
    reasons = [r["reason"] for r in arc_convert.rejected(spark, str(arcs)).collect()]
    assert len(reasons) == 2 and "no length" in reasons[0] and "does not end" in reasons[1]


def test_archives_of_both_versions_come_back_whole(spark, monkeypatch):
    monkeypatch.setattr(arc_convert, "FILE_BYTES", 100_000)
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = arc_convert.round_trip(pages).toPandas().sort_values("page_id")
    html = pages.toPandas().sort_values("page_id")
    wanted = [hashlib.sha1((t or "").encode()).hexdigest() for t in html["html"]]
    assert got["page_id"].tolist() == html["page_id"].tolist()
    assert got["payload_digest"].tolist() == wanted
