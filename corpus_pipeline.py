"""A training corpus from ``documents``: identify, clean, deduplicate, mix, pack.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and is
written and read again before the next. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import fair_mixing, ffd_packing, language_gru, minhash_forest, toxicity_chain
from clickloom.llm.workspace import Workspace

#: Pooled probability below which a document's language is not believed.
LEAST_LANGUAGE_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages; no letters or no clear language: out."""
    langs, model = language_gru.fit(docs)
    return language_gru.keep_identified(docs, langs, model, LEAST_LANGUAGE_SCORE)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain, fitted to those of them with labels, finds clean."""
    chain = toxicity_chain.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity_chain.keep_clean(docs, chain)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies."""
    return minhash_forest.keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return fair_mixing.mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences."""
    return ffd_packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

#: Learned stages and similarity groups have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result is a written table."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for place, (name, stage) in enumerate(STAGES):
        docs = work.save(stage(spark, docs, sf_dir), name)
        if place:
            work.drop(STAGES[place - 1][0])
    return docs
