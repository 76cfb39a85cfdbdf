"""One registered query per operator, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propfold.llm import (
    arc_convert,
    collocations,
    fill_middle,
    importance,
    language_id,
    license_scan,
    line_cleaning,
    mixing,
    near_dedup,
    packing,
    permutation_index,
    repeats,
    toxicity,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(license_scan.document_paths(table(spark, folder, "documents")))


def op2_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels")
    share = importance.target_share(labels)
    return importance.resample(table(spark, folder, "documents"), labels.where("quality = 1"), share)


def op3_permutation_index(spark: SparkSession, folder: str) -> DataFrame:
    return permutation_index.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_line_cleaning(spark: SparkSession, folder: str) -> DataFrame:
    return line_cleaning.clean_lines(table(spark, folder, "documents"), with_text=False)


def op5_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(packing.document_items(table(spark, folder, "documents")))


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = toxicity.fit(documents, labels.where(~toxicity.held_out(F.col("doc_id"))))
    return toxicity.score(documents, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"), size=4)


def op8_arc_convert(spark: SparkSession, folder: str) -> DataFrame:
    return arc_convert.round_trip(table(spark, folder, "pages"))


def op9_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeat_digest(table(spark, folder, "documents"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    rows = mixing.mix(table(spark, folder, "documents"))
    return rows.select(
        "doc_id",
        F.col("mix_source").alias("source"),
        F.col("mix_lang").alias("lang"),
        F.col("mix_topic").alias("topic"),
        F.col("mix_tokens").alias("n_tokens"),
        F.col("mix_rate").alias("rate"),
        F.col("mix_kept").alias("kept"),
    )


def op11_language_id(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = language_id.fit(documents.where(~language_id.held_out(F.col("doc_id"))))
    return language_id.predict(documents, model).select(
        "document.doc_id", language_id.held_out(F.col("document.doc_id")).alias("held_out"), "lang_pred", "score"
    )


def op12_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.fill_in_middle_digest(table(spark, folder, "documents"))


def op13_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.top_phrases(table(spark, folder, "documents"))


QUERIES = (
    op1_license_scan,
    op2_importance_resampling,
    op3_permutation_index,
    op4_line_cleaning,
    op5_best_fit_packing,
    op6_toxicity,
    op7_near_dedup,
    op8_arc_convert,
    op9_repeats,
    op10_mixing,
    op11_language_id,
    op12_fill_middle,
    op13_collocations,
)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in QUERIES}
