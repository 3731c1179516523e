"""Corpus pipeline: documents that a quality classifier and a toxicity scorer accept, without copies and near-copies, packed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from duolog.llm import exact_dedup, ngram_join, packing, quality, toxicity
from duolog.llm._scratch import materialize
from duolog.llm.queries import table, vocabulary_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted quality is 1; learnt from docs and the table labels."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; learnt from docs and the table labels."""
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a Jaccard similarity of 0.8 or more."""
    return ngram_join.distinct_documents(docs, width=5, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    return packing.packed(docs, vocabulary_path(), capacity=4096, end_id=1)


STAGES = [
    ("quality", keep_good),
    ("toxicity", keep_clean),
    ("exact_dedup", drop_copies),
    ("ngram_join", drop_near_copies),
    ("packing", pack),
]

#: Learnt models, components and bin packing are beyond SQL. Tests hold each stage against the scores of its rows or plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet in the shared folder and read again.

    Null texts and ids, repeated rows, empty tables and further columns pass through every stage; what a stage makes of them is
    told by its operator. All stages but the last return the columns of documents."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
