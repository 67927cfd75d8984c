"""Corpus pipeline: documents to packed sequences, in stages that are each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pointloom.llm.common import materialize, table
from pointloom.llm.mixing import mixed_rows
from pointloom.llm.packing import op3_packing
from pointloom.llm.simhash import distinct_documents
from pointloom.llm.suffix_dedup import without_repeats
from pointloom.llm.toxicity import keep_civil


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier calls toxic."""
    return keep_civil(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: SimHash links and beyond, with at least 0.8 of their five-word shingles in common."""
    return distinct_documents(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts out passages of 100 bytes or more that also stand earlier; documents stay, with what is left of them."""
    return without_repeats(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, once or twice."""
    return mixed_rows(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents and their places in sequences of 2048 tokens."""
    return op3_packing(docs)


STAGES = [
    ("toxicity", toxicity), ("near_copies", near_copies), ("repeated_passages", repeated_passages), ("mixture", mixture),
    ("packing", packing),
]

#: No stage can be stated in SQL: a fitted model, hashes of shingles and a tokenizer decide. Tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each on what its predecessor wrote."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, name)
    return docs
