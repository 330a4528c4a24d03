"""From raw documents to a weighted training corpus, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and returns the columns of
`documents`; the last adds `mix_rate`. Between stages the rows are written as Parquet and read again.

Null, empty and very long texts, repeated rows and ids, missing ids and columns of any name pass through every
stage as its operator defines; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfline.llm import decontaminate, jaccard, mixing, quality, secrets
from shelfline.llm.common import landed, small_batches, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    small_batches(spark)
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    small_batches(spark)
    return jaccard.one_of_each(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of a benchmark item occurs go."""
    small_batches(spark)
    return decontaminate.without_passages(docs, table(spark, sf_dir, "benchmark"))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; every document stays."""
    small_batches(spark)
    return secrets.redacted(docs)


#: shares of tokens in the mixture; documents of low quality have left in the first stage, so none are asked of them
TARGETS = {"q1t0": 0.98, "q1t1": 0.02}


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets the rate at which it enters the mixture."""
    return mixing.with_rates(docs, table(spark, sf_dir, "labels"), TARGETS)


STAGES = [
    ("quality", good_quality),
    ("near_copies", no_near_copies),
    ("benchmark", no_benchmark),
    ("secrets", no_secrets),
    ("mixing", mixture),
]

#: a classifier decides in the first stage, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = landed(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
