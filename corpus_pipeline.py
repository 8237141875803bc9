"""Corpus pipeline: toxicity, exact dedup, SimHash near-dedup, benchmark
decontamination, packing.

Each stage takes all documents its predecessor kept (read again from the table
it wrote), calls one operator of ``wordloom.llm`` and returns what stays, with
the columns of ``documents``; the last returns the packed pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wordloom.llm import chunk_recipes, decontaminate, packing, simhash_mih, toxicity
from wordloom.llm.common import materialise, table
from wordloom.llm.queries import tokenizer_path


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the toxicity operator does not reject (score below 0.7)."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one of smallest id."""
    return chunk_recipes.drop_copies(docs)


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (4-word shingles, 4 bits): the
    one of smallest id."""
    return simhash_mih.drop_near_copies(docs, shingle=4, max_bits=4)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover less than one word in twenty."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents left, packed into sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_path(), with_ids=False)


STAGES = [
    ("toxicity", remove_toxic),
    ("exact_dedup", remove_copies),
    ("near_dedup", remove_near_copies),
    ("decontamination", remove_contaminated),
    ("packing", pack),
]

ORACLE_SQL = None  # a trained model and a heuristic packing are no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
