"""One query per operator over its whole table; rows are digests of the operator's output."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.llm import (
    decontaminate, divergence, html_text, licences, line_rules, mixing, packing, pii, prefix_trie,
    quality, simhash, token_files, toxicity,
)
from tripline.llm.common import table
from tripline.llm.oracle import ORACLE  # noqa: F401
from tripline.sources.session import pin, scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Whole texts go to Python in batches of so many rows, to bound a worker's memory.
ARROW_ROWS = "500"


def prepared(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return pin(spark)


def query(build: Query) -> Query:
    """Register under the function's name, with session settings pinned."""
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(prepared(spark), sf_dir)
    QUERIES[build.__name__] = run
    return run


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.spans(table(spark, sf_dir, "documents")))


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents")).withColumn(
        "fingerprint", simhash.as_hex(F.col("fingerprint")))


@query
def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).select("page_id", "text")


def judged(scored: DataFrame, folds: int, held_out: int) -> DataFrame:
    return scored.select(
        "doc_id", F.coalesce(toxicity.fold(F.col("doc_id"), folds) == held_out, F.lit(False))
        .alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    return judged(toxicity.fit(docs, labels).score(docs), 5, 0)


@query
def op5_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token-blocks")
    token_files.write(table(spark, sf_dir, "documents"), path,
                      public_tokenizers.path("word_bpe_49k.json"), end=2)
    return token_files.digest(spark, path)


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return judged(quality.score(table(spark, sf_dir, "documents"), labels), 3, 1)


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pieces(table(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_50k.json"),
                          public_tokenizers.path("byte_bpe_50k.tiktoken"), end=1)


@query
def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"),
                                        table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@query
def op9_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.digest(line_rules.judge(table(spark, sf_dir, "documents")))


@query
def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


@query
def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(prefix_trie.rebuilt(table(spark, sf_dir, "conversations")))


@query
def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))
