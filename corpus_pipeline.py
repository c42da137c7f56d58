"""A training corpus from raw documents: five stages, each over all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatloom.llm import decontaminate, language_id, mixing, secret_scan, shingle_dedup
from seatloom.runtime import materialise, scope, table


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which no language holds half of the words."""
    model = language_id.train(docs.filter(~language_id.held_out(F.col("doc_id"))))
    return language_id.keep_identified(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: five-word shingles, Jaccard similarity 0.8 or more."""
    return shingle_dedup.dedup(docs)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item, its question or its answer."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts; keeps every document."""
    return secret_scan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: documents of which words are taken, with ``size`` and ``taken``."""
    return mixing.mixed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify),
    ("simhash_near_dedup", near_dedup),
    ("decontaminate", clean_of_benchmark),
    ("secret_scan", redact_secrets),
    ("mix_sources", mix),
]

#: A trained model is part of the pipeline, so SQL can't express it.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents table; each stage's result is written and read again, what it wrote besides is deleted."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with scope(spark):
            docs = materialise(stage(spark, docs, sf_dir), name, scoped=False)
    return docs
