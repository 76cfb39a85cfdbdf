"""The registered corpus queries by name, over whole tables: contract columns and rows."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver

FOLDER = "/root/testdata/sf0.001"

# Columns and types that a result has at least.
CONTRACT = {
    "op3_permutation_index": "query_id bigint, rank int, vec_id bigint, score double",
    "op4_line_cleaning": (
        "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
        "n_repeat_words bigint, base_failed boolean, kept boolean"
    ),
    "op6_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op7_near_dedup": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op8_arc_convert": (
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    ),
    "op9_repeats": "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
    "op11_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op12_fill_middle": (
        "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
        "output_sha256 string, restored_sha256 string"
    ),
    "op13_collocations": (
        "lang string, rank bigint, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint"
    ),
}


@pytest.fixture(scope="module")
def results(spark):
    made = {}

    def result(name):
        if name not in made:
            made[name] = driver.queries()[name](spark, FOLDER).cache()
        return made[name]

    return result


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}


def test_all_are_registered():
    names = [n for n in driver.queries() if n.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14)) and "pipeline" in driver.queries()


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_contract_columns(results, name):
    types = dict(results(name).dtypes)
    for column in CONTRACT[name].split(", "):
        wanted, kind = column.split()
        assert types[wanted] == kind


@pytest.mark.parametrize(
    "name", ["op1_license_scan", "op2_importance_resampling", "op4_line_cleaning", "op6_toxicity", "op7_near_dedup",
             "op9_repeats", "op10_mixing", "op11_language_id", "op12_fill_middle"]
)
def test_one_row_for_each_document(results, documents, name):
    ids = [r["doc_id"] for r in results(name).select("doc_id").collect()]
    assert sorted(ids) == sorted(documents)


def test_nearest_vectors(spark, results):
    rows = spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    vectors = {r["vec_id"]: np.array(r["embedding"], float) for r in rows if r["embedding"] is not None}
    ids = np.array(sorted(vectors))
    all_ = np.stack([vectors[i] for i in ids])
    found: dict[int, list] = {}
    for r in results("op3_permutation_index").orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(found) == {i for i in ids.tolist() if i % 100 == 0}
    hits = total = 0
    for query, rows in found.items():
        distance = np.sqrt(((all_ - vectors[query]) ** 2).sum(axis=1))
        near = [i for i in ids[np.lexsort((ids, distance))].tolist() if i != query][:10]
        assert [r[0] for r in rows] == list(range(1, len(near) + 1))
        assert all(abs(s - np.linalg.norm(vectors[v] - vectors[query])) < 1e-9 for _, v, s in rows)
        hits, total = hits + len(set(near) & {r[1] for r in rows}), total + len(near)
    assert hits >= 0.9 * total


def test_base_rule_of_line_cleaning(results):
    for r in results("op4_line_cleaning").collect():
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_toxicity_folds(results):
    for r in results("op6_toxicity").collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1


def test_language_folds(results):
    for r in results("op11_language_id").collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)


def test_near_duplicates_take_four_words(results, documents):
    sets = {}
    for doc_id, text in documents.items():
        words = text.encode().lower().split()
        sets[doc_id] = {tuple(words[k : k + 4]) for k in range(max(1, len(words) - 3))} if words else set()
    for r in results("op7_near_dedup").collect():
        assert r["n_shingles"] == len(sets[r["doc_id"]]) and r["kept"] == (r["doc_id"] == r["component_id"])


def test_repeats_are_removed_as_by_brute_force(results, documents):
    seen: dict[bytes, int] = {}
    data = {i: t.encode() for i, t in documents.items()}
    for text in data.values():
        for k in range(len(text) - 199):
            h = hash(text[k : k + 200])
            seen[h] = seen.get(h, 0) + 1
    found = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in results("op9_repeats").collect()}
    for doc_id, text in data.items():
        gone = np.zeros(len(text) + 1, dtype=int)
        for k in range(len(text) - 199):
            if seen[hash(text[k : k + 200])] > 1:
                gone[k] += 1
                gone[k + 200] -= 1
        covered = np.cumsum(gone)[: len(text)] > 0
        starts = int((covered & ~np.concatenate(([False], covered[:-1]))).sum()) if len(covered) else 0
        kept = bytes(np.frombuffer(text, np.uint8)[~covered])
        assert found[doc_id] == (len(text), int(covered.sum()), starts, hashlib.sha256(kept).hexdigest())


def test_packing_holds_all_tokens(results, documents):
    rows = results("op5_best_fit_packing")
    per_doc = {r["doc_id"]: r["n"] for r in rows.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert per_doc == {i: len(t.encode().split()) + 1 for i, t in documents.items()}
    bins = rows.groupBy("bin_id").agg(F.sum("length").alias("n"), F.max("bin_used").alias("u"), F.max("bin_size").alias("s"))
    assert bins.where("n <> u or u > s").isEmpty()


def test_pipeline_runs_through(results, documents):
    rows = results("pipeline")
    assert {"doc_id", "bin_id", "length"} <= set(rows.columns) and not rows.isEmpty()
    assert {r[0] for r in rows.select("doc_id").collect()} <= set(documents)
