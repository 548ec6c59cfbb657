"""Columns that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def long(value: int) -> Column:
    return F.lit(value).cast("long")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else.

    The engine's ``lower`` is fast but changes every script; texts without
    other capitals take it, the rest go through ``translate``.
    """
    other = F.rlike(text, F.lit(r"[\p{Lu}\p{Lt}\p{IsUppercase}&&[^A-Z]]"))
    return F.when(other, F.translate(text, UPPER, UPPER.lower())).otherwise(F.lower(text))


def text_key(text: Column) -> Column:
    """With doc_id it names a row's text: rows that share both are alike in all
    that is computed from the text, so a null or repeated doc_id does no harm."""
    return F.xxhash64(text)


def indexes(count: Column) -> Column:
    """0 .. count-1; empty for a count below one."""
    return F.when(count > 0, F.sequence(F.lit(0), (count - 1).cast("int"))).otherwise(
        F.array().cast("array<int>"))


def empty_as(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def same_rows(left: DataFrame, right: DataFrame, *keys: str) -> Column:
    """Null-safe equality on ``keys``; Spark still joins by hash or sort."""
    condition = None
    for key in keys:
        each = left[key].eqNullSafe(right[key])
        condition = each if condition is None else condition & each
    return condition
