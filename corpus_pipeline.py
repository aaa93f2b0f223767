"""A corpus pipeline: language ID, near duplicates, decontamination, personal data, packing.

Every stage reads what its predecessor kept, whole, from Parquet; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pulseframe.llm import common, decontamination, jaccard_join, language_id, packing, surrogates


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without any letter: they have no language."""
    return language_id.accept(docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each class linked by five-word shingles at a similarity of 0.8 or more."""
    return jaccard_join.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop contaminated documents and cut benchmark spans from the others."""
    return decontamination.clean(docs, common.table(spark, sf_dir, "benchmark"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by surrogates."""
    return surrogates.protect(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deal the documents into sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", known_language),
    ("jaccard_join", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("surrogates", without_personal_data),
    ("packing", packed),
]

#: Signature sketches, collision attempts and best fit are beyond SQL; tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
