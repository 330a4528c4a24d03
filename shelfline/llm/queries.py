"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from shelfline.llm import (
    chat, decontaminate, jaccard, mixing, pseudo, quality, ranked, repair, secrets, suffixes, toxicity, vectors, warc)
from shelfline.llm.common import table
from shelfline.llm.sql import SQL  # noqa: F401


def op1_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo.scores(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_copies(table(spark, sf_dir, "embeddings"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_documents(table(spark, sf_dir, "documents")).drop("cls")


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeats_removed(table(spark, sf_dir, "documents")).drop("kept")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(decontaminate.occurrences(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.report(chat.formatted(chat.with_probe(table(spark, sf_dir, "conversations"))))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audits(repair.damaged(table(spark, sf_dir, "conversations")), gone="gone")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_pseudo_likelihood, op2_secret_scan, op3_quality, op4_embedding_neardup, op5_ngram_jaccard,
        op6_warc_derivatives, op7_toxicity, op8_mixing, op9_suffix_dedup, op10_decontamination,
        op11_chat_format, op12_ranked_search, op13_conversation_repair)
} | {"pipeline": corpus_pipeline.run}
