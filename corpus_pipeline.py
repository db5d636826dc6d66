"""A corpus pipeline: each stage reads what the stage before it kept, as a table.

Low quality goes, one document of each group of near duplicates stays, passages that repeat are cut, documents with
benchmark passages go, and what is left is packed into sequences. Every stage but the last returns the columns of
``documents``; rows with null texts or ids pass through like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rfsight.llm import contamination, ngram_join, packing, quality, suffix_dedup
from rfsight.llm.queries import table, tokenizer_file
from rfsight.llm.scratch import stored
from rfsight.llm.ship import ship


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest-neighbour vote takes for quality 1."""
    return quality.keep_good(docs, table(ship(spark), sf_dir, "labels"))


def ngram_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest id, of each group connected by five-gram links."""
    ship(spark)
    return ngram_join.one_of_each(docs)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of over 50 words that occur more than once in what came in."""
    ship(spark)
    return suffix_dedup.without_passages(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark."""
    return contamination.clean(docs, table(ship(spark), sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 1024 tokens."""
    ship(spark)
    return packing.pack_documents(docs, tokenizer_file())


STAGES = [
    ("quality", quality_stage),
    ("ngram_join", ngram_stage),
    ("suffix_dedup", suffix_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: A nearest-neighbour vote and a tokenizer have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ship(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
