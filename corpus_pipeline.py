"""Corpus pipeline: toxicity, near-duplicates, decontamination, personal data, packing.

Every stage works on all that its predecessor kept and is written before the
next one reads it. All but the last return the columns they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.llm import decontaminate, packing, pii, simhash, toxicity
from tripline.llm.common import table
from tripline.llm.queries import prepared
from tripline.sources.session import settle


def toxic_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; the model learns from the labels of ``docs``."""
    prepared(spark)
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    return toxicity.fit(docs, labels).accept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: that with the smallest doc_id."""
    prepared(spark)
    return simhash.keep_one(docs)


def benchmark_overlap(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    prepared(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and telling terms are masked in the text, and n_chars follows it."""
    prepared(spark)
    clean = pii.sanitise(docs)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.coalesce(
        F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their place in sequences of 2048 ids."""
    prepared(spark)
    return packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.json"),
                          public_tokenizers.path("byte_bpe_50k.tiktoken"), end=1)


STAGES = [
    ("toxicity", toxic_texts),
    ("simhash", near_duplicates),
    ("decontamination", benchmark_overlap),
    ("pii", personal_data),
    ("packing", packed),
]

#: Models and tokenizers are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
