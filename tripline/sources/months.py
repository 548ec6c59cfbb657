"""Monthly trip files: scan, month from the file name, idempotent landing."""

from __future__ import annotations

import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DataType, DoubleType, FloatType, IntegerType, LongType, ShortType, StructField,
    StructType, TimestampNTZType, TimestampType,
)

from tripline.functions.keys import file_id, row_address, row_file
from tripline.sources import ledger
from tripline.sources.ledger import month_fields
from tripline.sources.files import literal_rows
from tripline.sources.schemas import MONTHS, TRIP_FILES

NO_MONTH = "not landed: no YYYY-MM.parquet in its name"
# What Spark raises for footers that it cannot merge, or cannot read at all.
UNREADABLE_TOGETHER = (PySparkException, Py4JJavaError)
PIECES = 16
LANDED, ADDED, REPLACED = "landed", "late files added", "replaced"


def _readable(stored: DataType) -> DataType:
    """The type to read a column with: the reader widens whole and broken numbers
    and takes either kind of timestamp, but never turns one into another."""
    if isinstance(stored, (ByteType, ShortType, IntegerType, LongType)):
        return LongType()
    if isinstance(stored, (FloatType, DoubleType)):
        return DoubleType()
    if isinstance(stored, TimestampType):
        return TimestampNTZType()
    return stored


def _stored(spark: SparkSession, paths: list[str], schema: StructType) -> StructType:
    """How all files below ``paths`` store the columns of ``schema``. Spark reads the
    footers in tasks; files that disagree raise."""
    found = (spark.read.option("recursiveFileLookup", True).option("mergeSchema", True)
             .parquet(*paths).schema)
    return StructType([StructField(f.name, _readable(
        found[f.name].dataType if f.name in found.fieldNames() else f.dataType), True)
        for f in schema.fields])


def _escaped(path: str) -> str:
    """A path that is meant as it stands, not as a pattern."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def by_storage(spark: SparkSession, files: list[str],
               schema: StructType = TRIP_FILES) -> list[tuple[StructType, list[str]]]:
    """The files in groups that one scan can read, each with the types to read.

    Files that agree, as nearly all do, take one job for all their footers; a
    group that does not agree is cut into ``PIECES`` until its parts do. Jobs of a
    round run side by side.
    """
    def attempt(part: list[str]) -> StructType | None:
        try:
            return _stored(spark, [_escaped(f) for f in part], schema)
        except UNREADABLE_TOGETHER:
            if len(part) == 1:
                raise
            return None

    groups: dict[str, tuple[StructType, list[str]]] = {}
    waiting = [files] if files else []
    with ThreadPoolExecutor(PIECES) as pool:
        while waiting:
            found = list(zip(waiting, pool.map(attempt, waiting)))
            waiting = [part[i::PIECES] for part, stored in found if stored is None
                       for i in range(min(PIECES, len(part)))]
            for part, stored in found:
                if stored is not None:
                    groups.setdefault(stored.simpleString(), (stored, []))[1].extend(part)
    return [(stored, sorted(part)) for _, (stored, part) in sorted(groups.items())]


def _number(name: str, stored: DataType) -> Column:
    """A zone id as int. Columns with gaps are stored as broken numbers, gaps as
    NaN; a broken id raises."""
    c = F.col(name)
    if not isinstance(stored, DoubleType):
        return c.cast("int")
    return F.when(c.isNull() | F.isnan(c), None).when(c == F.floor(c), c.cast("int")).otherwise(
        F.raise_error(F.concat(F.lit(f"{name} is no id: "), c.cast("string"))))


def month_rows(files: DataFrame, *roots: str, schema: StructType = TRIP_FILES) -> DataFrame:
    """Add ``trip_id``, ``year`` and ``month`` to a scan, batch or stream.

    ``trip_id`` is the row's address below the folders ``roots``, so exact
    copies keep separate ids, and ids stay when a folder moves. Columns are cast
    to ``schema``, zone ids to int.
    """
    year, month = month_fields(F.col("_metadata.file_path"))
    stored = {f.name: f.dataType for f in files.schema.fields}

    def column(f: StructField) -> Column:
        if f.name.endswith("LocationID"):
            return _number(f.name, stored[f.name])
        return F.col(f.name) if stored[f.name] == f.dataType else F.col(f.name).cast(f.dataType)

    return files.select(
        row_address(*roots).alias("trip_id"), *(column(f).alias(f.name) for f in schema.fields),
        year.try_cast("int").alias("year"), month.try_cast("int").alias("month"))


def read_files(spark: SparkSession, files: list[str], *roots: str,
               schema: StructType = TRIP_FILES) -> DataFrame:
    """The given trip files, which may store the columns in different types: one
    scan for each way of storing them, cast and united by name."""
    united = None
    for stored, part in by_storage(spark, files, schema):
        scan = spark.read.schema(stored).parquet(*map(_escaped, part))
        rows = month_rows(scan, *roots, schema=schema)
        united = rows if united is None else united.unionByName(rows)
    if united is None:
        return spark.createDataFrame([], _landed_schema(schema))
    return united


def file_ids(spark: SparkSession, files: list[str], source: str) -> DataFrame:
    """The ids of the given files, as in the addresses of their rows."""
    names = (spark.read.format("binaryFile").load([_escaped(f) for f in files])
             if files else spark.createDataFrame([], "file_id string"))
    return names.select(file_id(source).alias("file_id")) if files else names


def read_months(spark: SparkSession, *paths: str, schema: StructType = TRIP_FILES) -> DataFrame:
    """All trip files below the given paths, any number of months, whatever types
    they store."""
    # a glob names files: its folder is the root
    roots = [p.rsplit("/", 1)[0] if set(p) & set("*?{[") or p.endswith(".parquet") else p
             for p in paths]
    try:
        stored = _stored(spark, list(paths), schema)
    except UNREADABLE_TOGETHER:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                 .load(list(paths)).select("path"))
        return read_files(spark, [r.path for r in files.toLocalIterator()], *roots, schema=schema)
    scan = spark.read.schema(stored).option("recursiveFileLookup", True).parquet(*paths)
    return month_rows(scan, *roots, schema=schema)


def read_all(spark: SparkSession, source: str, target: str,
             schema: StructType = TRIP_FILES) -> DataFrame:
    """Landed rows and those of files in ``source`` that have yet to land, as one table."""
    waiting = pending_files(spark, source, target).where("state = 'new'")
    arrived = read_files(spark, [r.path for r in waiting.toLocalIterator()], source, schema=schema)
    return read_landed(spark, target, schema).unionByName(arrived)


def months_in(spark: SparkSession, source: str) -> DataFrame:
    """Distinct (year, month) of the month files or folders in ``source``, from
    names alone: listed, not opened."""
    return ledger.listed(spark, source).select("year", "month").dropna().distinct()


def months_landed(spark: SparkSession, target: str) -> DataFrame:
    """(year, month) partitions of ``target``. Only the two folder levels are
    listed, never the files: a month's folder appears when its write commits."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/year=*/month=*")
    store = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [status.getPath().toString() for status in store.globStatus(pattern) or []]
    found = [re.search(r"/year=(\d+)/month=(\d+)$", name) for name in names]
    return literal_rows(spark, [(int(m[1]), int(m[2])) for m in found if m], MONTHS)


def pending_files(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Files of ``source`` that are not in ``target`` as they stand now: rows of
    ``ledger.listed`` with ``month_landed`` and ``state``: new, or changed since it landed.

    Months that landed without a log tell their files by their rows' ids.
    """
    here = months_landed(spark, target)
    log = ledger.entries(spark, target).select("file_id", F.col("size").alias("had_size"),
                                               F.col("modified").alias("had_time"),
                                               "year", "month")
    unlogged = here.join(log, ["year", "month"], "left_anti")
    known = log.drop("year", "month")
    if not unlogged.isEmpty():
        ids = read_landed(spark, target).join(unlogged, ["year", "month"], "left_semi").select(
            row_file("trip_id").alias("file_id")).distinct()
        known = known.unionByName(ids.select("file_id", F.lit(None).cast("long").alias("had_size"),
                                             F.lit(None).cast("timestamp").alias("had_time")))
    found = ledger.listed(spark, source).join(known.withColumn("known", F.lit(True)), "file_id", "left")
    same = F.col("size").eqNullSafe(F.col("had_size")) & F.col("modified").eqNullSafe(F.col("had_time"))
    state = F.when(F.col("known").isNull(), "new").when(~same & F.col("had_size").isNotNull(), "changed")
    found = found.withColumn("state", state).where("state IS NOT NULL").drop(
        "known", "had_size", "had_time")
    marked = here.withColumn("month_landed", F.lit(True))
    return found.join(marked, ["year", "month"], "left").withColumn(
        "month_landed", F.coalesce("month_landed", F.lit(False)))


def land_months(spark: SparkSession, source: str, target: str,
                schema: StructType = TRIP_FILES, replace: bool = False,
                isolate: bool = False) -> dict[str, str]:
    """Land the files of ``source`` that are not yet in ``target``; return month -> state,
    and ``NO_MONTH`` for each file whose name has no month: it cannot be placed.

    The log of landed files says what is pending. New files of a month that has
    landed are added to it: its partition is written again from the rows it has
    of other files and those that came, so a landing that died and is run again
    doubles nothing. A file that changed since it landed stays out, like every file
    that has landed it is not opened, unless ``replace`` is set: months with new or
    changed files are then written anew from the files in ``source`` alone. The
    dynamic overwrite swaps whole month partitions. ``isolate`` runs one job per
    month and goes on after a bad one.
    """
    pending = pending_files(spark, source, target).collect()  # names of files, no data
    odd = {r.path: NO_MONTH for r in pending if r.year is None or r.month is None}
    due = {(r.year, r.month): r.month_landed for r in pending
           if r.path not in odd and (replace or r.state == "new")}
    coming = [r for r in pending if r.state == "new"]
    if replace and due:
        coming = ledger.listed(spark, source).collect()

    def land(group: list[tuple[int, int]]) -> None:
        files = [r for r in coming if (r.year, r.month) in group]
        logged = spark.createDataFrame([tuple(r[c] for c in ledger.LISTED) for r in files],
                                       ledger.LISTED_SCHEMA)
        rows = read_files(spark, [r.path for r in files], source, schema=schema)
        held = [m for m in group if due[m]]
        if held and not replace:
            others = read_landed(spark, target, schema).where(in_months(held))
            rows = rows.unionByName(others.join(
                logged, row_file("trip_id") == F.col("file_id"), "left_anti"))
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("year", "month").parquet(target))
        ledger.append(logged, target, whole_months=replace)

    state: dict[str, str] = dict(sorted(odd.items()))
    for group in ([[m] for m in sorted(due)] if isolate else [sorted(due)] if due else []):
        try:
            land(group)
            done = {m: LANDED if not due[m] else REPLACED if replace else ADDED for m in group}
        except Exception as error:
            if not isolate:
                raise
            done = dict.fromkeys(group, f"failed: {str(error).splitlines()[0]}")
        state.update({f"{y:04d}-{m:02d}": done[y, m] for y, m in group})
    return state


def _landed_schema(schema: StructType) -> str:
    fields = ", ".join(
        f"{f.name} {'int' if f.name.endswith('LocationID') else f.dataType.simpleString()}"
        for f in schema.fields)
    return f"trip_id string, {fields}, year int, month int"


def in_months(months: Iterable[tuple[int, int]]) -> Column:
    """A filter on year and month that prunes partitions."""
    return (F.col("year") * 12 + F.col("month")).isin(sorted(y * 12 + m for y, m in months))


def read_landed(spark: SparkSession, target: str, schema: StructType = TRIP_FILES) -> DataFrame:
    """Landed trips; filters on year and month prune whole partitions."""
    return spark.read.schema(_landed_schema(schema)).parquet(target)
