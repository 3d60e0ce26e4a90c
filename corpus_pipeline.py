"""The corpus pipeline: documents through filters and deduplication into packed sequences.

Every stage takes all rows that the one before kept and returns the columns of documents, the last one the pieces of packed sequences. Null and
empty texts are not toxic, but in no language, so the second stage drops them. Rows that repeat an id are each judged by their own text; equal texts are judged alike, and of
them the third stage keeps one row, that with the largest id. Of near copies the smallest id stays. Texts are taken whole at any length, other columns, of any name, pass
through. An empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from livegauge.llm.common import Scratch, collected
from livegauge.llm.exact import drop_exact
from livegauge.llm.language import keep_known
from livegauge.llm.minhash import drop_near
from livegauge.llm.packing import pack
from livegauge.llm.toxicity import keep_clean


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that score below 0.7 for toxicity; learned from the labels of these documents."""
    return keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in a language: scored by the machines that learn from the labelled ones, none below the least score of those; without a letter there is none."""
    return keep_known(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, the one with the largest doc_id."""
    return drop_exact(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return drop_near(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("language ID", language),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("packing", packing),
]

# Signatures, classifiers and tokenizers have no SQL; tests hold every stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each written to the shared folder and read again as the next one's documents. Each one's tables are removed once
    the next is written."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        with collected():  # tables of the stage itself
            kept = scratch.keep(stage(spark, docs, sf_dir))
        scratch.only(kept)  # the stage before is not read any more
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
