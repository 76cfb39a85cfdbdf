"""A corpus pipeline: toxicity, near duplicates, repeated passages, mixing and packing.

Each stage takes the documents that the one before it wrote, and all but the last return
the columns of documents. Empty tables pass through; null and empty texts are not toxic,
are copies of nothing and hold no repeats.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propfold.llm import mixing, near_dedup, packing, repeats, toxicity
from propfold.llm.staging import new_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels at hand, does not call toxic."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    name = "score"
    while name in docs.columns:
        name += "_"
    scored = toxicity.score(docs, model, docs.columns, name)
    return scored.where(F.col(name) < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates; rows without an id stay."""
    copies = near_dedup.near_duplicates(docs).where("not kept and doc_id is not null")
    return docs.join(copies.select("doc_id"), "doc_id", "left_anti").select(*docs.columns)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur elsewhere as well; n_chars follows."""
    return repeats.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at the rates that meet the target weights."""
    return mixing.mix(docs).where("mix_kept").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each document, or piece of one, in a sequence."""
    return packing.pack(packing.document_items(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("repeats", drop_repeats),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# No stage but the draw of mixing could be said in SQL, so there is none for the whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, rows, sf_dir).write.parquet(path)
        rows = spark.read.parquet(path)
    return rows
