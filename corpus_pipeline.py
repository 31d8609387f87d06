"""From documents to tokens: the stages of a training-data pipeline.

Each stage takes the documents that the one before it has written, and all but the last return documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from regionpulse.llm import bpe, decontamination, line_chunks, near_duplicates, toxicity
from regionpulse.llm.common import release, table
from regionpulse.session import stage


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model finds toxic go; it learns from the labels of the documents at hand."""
    return toxicity.non_toxic(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Chunks of lines cut by content, and passages of two or more lines, that stand earlier go; no document goes."""
    return line_chunks.dedup_lines(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return near_duplicates.dedup(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, with a digest of the text decoded from them."""
    return bpe.encode(docs)


STAGES = [("toxicity", toxic), ("line_dedup", lines), ("near_duplicates", near), ("decontamination", leaks), ("bpe", tokens)]

#: SQL can express neither the model nor the tokens; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
        release(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
