"""The corpus pipeline: each stage takes the documents its predecessor kept and hands on those it keeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from comanda.llm import dedup, packing, pii, quality, toxicity
from comanda.llm.common import table
from comanda.llm.queries import vocabulary
from comanda.session import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic."""
    return toxicity.reject_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the learned ones."""
    return quality.keep_quality(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near-duplicates."""
    return dedup.drop_near_duplicates(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.mask_documents(docs, pii.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 4096 ids."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", keep_quality),
    ("near duplicates", drop_near_duplicates),
    ("personal data", mask_personal_data),
    ("packing", pack),
]

# Learned stages can't be written in SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces in sequences of what is left of `documents`."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
