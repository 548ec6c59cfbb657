"""Streaming request scoring and streaming trip ingest.

Both read files as they arrive, run the batch operators unchanged and write
Parquet. The checkpoint makes each input file count once across restarts and
lost executors; it must lie in shared storage and stay with its output.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from tripline.functions.keys import row_file
from tripline.operators.clean import clean_observed, clean_trips
from tripline.operators.model import load, predict, score_requests
from tripline.operators.requests import (
    check_requests, checked_rejects, checked_valid, rejected_requests, replies,
)
from tripline.sources import months, published
from tripline.sources.files import literal_rows
from tripline.sources.schemas import (
    AUDIT, MALFORMED, MONTHS, REQUEST_LINES, SAMPLES, TRIP_FILES,
)
from tripline.sources.session import remove, settle, work_folder

FILES_PER_BATCH = 1000

#: Spark forgets files that are older than this beside the newest one, and then
#: never reads them; late files must count whatever their age. The price is a
#: list of seen files that keeps growing: archive sources once a year or so.
MAX_FILE_AGE = "36500d"


def file_stream(spark: SparkSession, path: str, schema: StructType,
                files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Parquet files at or below ``path`` as a stream; batches are bounded by the
    number of files."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .option("maxFileAge", MAX_FILE_AGE)
            .option("recursiveFileLookup", True).parquet(path))


def request_stream(spark: SparkSession, path: str,
                   files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """JSON-line requests as a stream, in the form of ``files.read_requests``."""
    return (spark.readStream.schema(REQUEST_LINES).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", MALFORMED)
            .option("maxFileAge", MAX_FILE_AGE)
            .option("maxFilesPerTrigger", files_per_batch).json(path))


def _to_parquet(rows: DataFrame, target: str, checkpoint: str, *partitions: str,
                drain: bool = True) -> StreamingQuery:
    writer = (rows.writeStream.format("parquet").outputMode("append")
              .option("path", target).option("checkpointLocation", checkpoint))
    if partitions:
        writer = writer.partitionBy(*partitions)
    if drain:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def _by_batch(rows: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str,
              drain: bool) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if drain else writer).start()


# --- requests -------------------------------------------------------------

def stream_replies(scored: DataFrame, key: str, target: str, checkpoint: str,
                   drain: bool = True) -> StreamingQuery:
    """Write the replies to a stream of scored requests.

    With ``drain`` the query ends once the present files are done.
    """
    return _to_parquet(replies(scored, key), target, checkpoint, drain=drain)


def stream_rejected(requests: DataFrame, key: str, target: str, checkpoint: str,
                    drain: bool = True) -> StreamingQuery:
    """Write the invalid ones among a stream of text requests, with reasons."""
    return _to_parquet(rejected_requests(requests, key), target, checkpoint, drain=drain)


def stream_scores(model: PipelineModel, requests: DataFrame, key: str, target: str,
                  checkpoint: str, drain: bool = True) -> StreamingQuery:
    """Score the valid ones among a stream of text requests."""
    return stream_replies(score_requests(model, requests, key), key, target, checkpoint, drain)


#: Typed requests -> the same with ``prediction`` and, if it likes, ``model_version``.
Predictor = Callable[[DataFrame], DataFrame]


def published_predictor(spark: SparkSession, out: str, name: str = "model") -> Predictor:
    """Score with the version of a published forest that counts when a batch begins.

    A running stream takes a new version up with its next batch. Replies name
    the version, so it can be told which forest gave them.
    """
    loaded: dict[int, PipelineModel] = {}

    def score(rows: DataFrame) -> DataFrame:
        number, folder = published.version_of(spark, out, "the trip job")
        if number not in loaded:
            loaded.clear()
            loaded[number] = load(spark, f"{folder}/{name}")
        return predict(loaded[number], rows).withColumn("model_version", F.lit(number))

    return score


def answer_batch(batch: DataFrame, batch_id: int, key: str, predictor: Predictor, target: str) -> None:
    """Replies and rejects of one micro-batch, below ``replies/batch=N`` and
    ``rejected/batch=N``.

    The requests are read and checked once and settled for both outputs. A batch
    that is run again, after a failure between the two or before the checkpoint
    saw it, replaces what it wrote: nothing doubles.
    """
    spark = batch.sparkSession
    work = work_folder(spark)
    try:
        checked = settle(check_requests(batch), "checked", work)
        scored = predictor(checked_valid(checked, key))
        named = [c for c in ("model_version",) if c in scored.columns]
        (replies(scored, key, *named).write.mode("overwrite")
         .parquet(f"{target}/replies/batch={batch_id}"))
        (checked_rejects(checked, key).write.mode("overwrite")
         .parquet(f"{target}/rejected/batch={batch_id}"))
    finally:
        remove(spark, work)


def stream_answers(requests: DataFrame, key: str, predictor: Predictor, target: str,
                   checkpoint: str, drain: bool = True) -> StreamingQuery:
    """Replies and rejects of a stream of text requests from one reading of it."""
    return _by_batch(requests, lambda batch, batch_id: answer_batch(
        batch, batch_id, key, predictor, target), checkpoint, drain)


# --- trips ----------------------------------------------------------------

def stream_ingest(trips: DataFrame, keep: list[str], target: str, checkpoint: str,
                  partitions: tuple[str, ...] = (), drain: bool = True) -> StreamingQuery:
    """Clean a stream of trips into Parquet, keeping the columns ``keep`` as well.

    A file changed in place is not read again; corrections go through
    ``stream_corrections`` or ``sources.months.land_months``.
    """
    return _to_parquet(clean_trips(trips, *keep), target, checkpoint, *partitions, drain=drain)


def stream_months(spark: SparkSession, source: str, target: str, checkpoint: str,
                  drain: bool = True) -> StreamingQuery:
    """Clean monthly trip files as they arrive, partitioned by year and month."""
    trips = months.month_rows(file_stream(spark, source, TRIP_FILES), source)
    return stream_ingest(trips, ["trip_id", "year", "month"], target, checkpoint,
                         ("year", "month"), drain)


def audit_batch(batch: DataFrame, batch_id: int, keep: list[str], target: str, audits: str) -> None:
    """Clean trips of one micro-batch into ``target/batch=N``, and the audit of that
    same pass into ``audits/batch=N``. Run again, both are replaced."""
    rows, audit = clean_observed(batch, *keep)
    rows.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
    counts = tuple(audit.get[name] for name in AUDIT.fieldNames())
    (literal_rows(batch.sparkSession, [counts], AUDIT).write.mode("overwrite")
     .parquet(f"{audits}/batch={batch_id}"))


def stream_audited(trips: DataFrame, keep: list[str], target: str, audits: str, checkpoint: str,
                   drain: bool = True) -> StreamingQuery:
    """Clean a stream of trips and record what each micro-batch lost by which rule.

    The counts are observed while the rows are written, so a batch is read once.
    """
    return _by_batch(trips, lambda batch, batch_id: audit_batch(
        batch, batch_id, keep, target, audits), checkpoint, drain)


DELIVERIES = StructType([*MONTHS.fields, StructField("delivery", StringType(), True)])
CORRECTED = StructType([StructField("trip_id", StringType(), True), *SAMPLES.fields,
                        DELIVERIES["delivery"], *MONTHS.fields])


def delivery_of(path: Column, source: str) -> Column:
    """The folder below ``source`` that a file came in; empty directly in it."""
    bare = re.sub(r"^[a-z0-9]+:(//[^/]*)?", "", source).strip("/")
    return F.regexp_extract(path, f"{re.escape(bare)}/+([^/]+)/", 1)


def read_corrected(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(CORRECTED).parquet(target)


def correct_months(files: DataFrame, source: str, target: str) -> None:
    """Bring the months that ``files`` (a column ``path``) hold to their newest delivery.

    A delivery is a folder of ``source``, and names sort by age: of each month the
    newest delivery counts as the whole month, in one file or several, at once or
    in turn. Rows of older deliveries go, and a file of an older one that comes
    late is passed over. The month partitions are written anew from what they hold of the
    newest delivery and the new files, without what they hold of these files, so
    running it again changes nothing.
    """
    spark = files.sparkSession
    came = files.select("path", delivery_of(F.col("path"), source).alias("delivery"),
                        *(part.try_cast("int").alias(name) for name, part in zip(
                            ("year", "month"), months.month_fields(F.col("path")))))
    named = [r for r in came.collect() if r.year is not None and r.month is not None]
    if not named:
        return
    due = months.in_months({(r.year, r.month) for r in named})
    try:
        held = read_corrected(spark, target).where(due)
        last = {(r.year, r.month): r.delivery
                for r in held.groupBy("year", "month").agg(F.max("delivery").alias("delivery")).collect()}
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        held, last = None, {}
    newest = dict(last)
    for r in named:
        newest[r.year, r.month] = max(r.delivery, newest.get((r.year, r.month), r.delivery))
    paths = [r.path for r in named if r.delivery == newest[r.year, r.month]]
    changed = {(r.year, r.month) for r in named if r.path in set(paths)}
    if not changed:
        return
    deliveries = literal_rows(spark, [(*m, newest[m]) for m in sorted(changed)], DELIVERIES)
    rows = clean_trips(months.read_files(spark, paths, source), "trip_id", "year", "month").join(
        deliveries, ["year", "month"])
    if held is not None:
        kept = held.join(deliveries, ["year", "month", "delivery"], "left_semi")
        rows = rows.unionByName(kept.join(months.file_ids(spark, paths, source), row_file(
            "trip_id") == F.col("file_id"), "left_anti"))
    work = work_folder(spark)
    try:
        rows = settle(rows, "months", work)
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("year", "month").parquet(target))
        left = {(r.year, r.month) for r in rows.select("year", "month").distinct().collect()}
        for year, month in changed - left:  # its newest delivery has no clean trip
            remove(spark, f"{target}/year={year}/month={month}")
    finally:
        remove(spark, work)


def stream_corrections(spark: SparkSession, source: str, target: str, checkpoint: str,
                       drain: bool = True, files_per_batch: int = FILES_PER_BATCH) -> StreamingQuery:
    """Clean monthly trip files as they arrive in ``source/<delivery>/``, where a later
    delivery of a month corrects it (see ``correct_months``).

    The stream itself reads file names only. So files may store their columns in
    any types that ``months.read_files`` reads, and differ in them.
    """
    names = file_stream(spark, source, TRIP_FILES, files_per_batch).select(
        F.col("_metadata.file_path").alias("path"))

    def each(batch: DataFrame, _: int) -> None:
        work = work_folder(spark)
        try:
            correct_months(settle(batch.distinct(), "names", work), source, target)
        finally:
            remove(spark, work)

    return _by_batch(names, each, checkpoint, drain)
