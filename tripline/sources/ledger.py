"""Which files have landed: a log beside the landed table, one row a file and landing.

A landing writes its data first and its log rows last. If it dies in between, the
next one finds the files still pending and lands them again, which replaces
what they left behind.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.functions.keys import file_id

#: Spark's readers pass over names with a leading underscore.
FOLDER = "_landed_files"

LISTED = ("file_id", "path", "size", "modified", "year", "month")
LISTED_SCHEMA = "file_id string, path string, size long, modified timestamp, year int, month int"
LOG = LISTED_SCHEMA + ", landing string, at timestamp, whole_month boolean"

# Fixed format: a month's file, or folder of files, ends in YYYY-MM.parquet.
MONTH_NAME = r"(\d{4})-(\d{2})\.parquet"


def month_fields(path: Column) -> tuple[Column, Column]:
    """(year, month) from a file path; empty text when the name has none."""
    return (F.regexp_extract(path, MONTH_NAME, 1), F.regexp_extract(path, MONTH_NAME, 2))


def listed(spark: SparkSession, source: str) -> DataFrame:
    """The Parquet files, and files of Parquet folders, in ``source``: file_id, path, size,
    modified, year, month (null without one in the name). Listed, not opened."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .load(f"{source}/*.parquet"))
    year, month = month_fields(F.col("_metadata.file_path"))
    return files.select(
        file_id(source).alias("file_id"), "path", F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"), year.try_cast("int").alias("year"),
        month.try_cast("int").alias("month"))


def entries(spark: SparkSession, target: str) -> DataFrame:
    """The last log row of each file whose rows the table holds.

    A landing of whole months ends what was there before: files that it did not
    bring are no longer in the table.
    """
    try:
        log = spark.read.schema(LOG).parquet(f"{target}/{FOLDER}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)
    since = log.where("whole_month").groupBy("year", "month").agg(F.max("at").alias("since"))
    held = log.join(since, ["year", "month"], "left").where("since IS NULL OR at >= since")
    return held.groupBy("file_id").agg(
        F.max_by(F.struct("path", "size", "modified", "year", "month", "landing", "at", "whole_month"),
                 "at").alias("last")).select("file_id", "last.*")


def append(files: DataFrame, target: str, whole_months: bool) -> None:
    """Log ``files`` (rows of ``listed``) as landed together."""
    (files.select(*LISTED, F.lit(uuid.uuid4().hex).alias("landing"), F.current_timestamp().alias("at"),
                  F.lit(whole_months).alias("whole_month"))
     .coalesce(1).write.mode("append").parquet(f"{target}/{FOLDER}"))
