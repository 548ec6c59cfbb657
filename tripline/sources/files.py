"""Zone table, artefact files, presence check."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tripline.functions.geo import LambertConic
from tripline.functions.wkt import lambert_conic
from tripline.sources.schemas import MALFORMED, REQUEST_LINES, ZONES


class MissingArtefact(FileNotFoundError):
    """An input that an earlier job should have written is not there."""


@contextmanager
def written_by(job: str, path: str):
    """Turn a missing path into an error that names the job to run."""
    try:
        yield
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise MissingArtefact(f"{path} not found; run {job} first") from error


def read_zone_records(spark: SparkSession, path: str) -> DataFrame:
    """Zone lines from CSV, columns by the names in the header, with their ``line``.

    ``line`` orders lines by file path, then by place in the file. Text that is
    no number raises, as does a missing column; files below ``path`` must
    agree in their header.
    """
    with written_by("the zone export (tripline zones)", path):
        names = spark.read.option("header", True).csv(path).columns
    missing = sorted(set(ZONES.fieldNames()) - set(names))
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    known = {f.name: f for f in ZONES.fields}
    schema = StructType([known.get(n, StructField(n, StringType())) for n in names])
    lines = (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
             .option("mode", "FAILFAST").csv(path))
    return lines.select(*ZONES.fieldNames(), F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row")).alias("line"))


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone table from CSV, one row per id: on a repeated id the later line wins,
    by file path, then by place in the file."""
    return latest_zones(read_zone_records(spark, path), "line")


def latest_zones(records: DataFrame, order: str) -> DataFrame:
    """The last record by ``order`` of each zone id."""
    last = F.max_by(F.struct(*ZONES.fieldNames()), order).alias("zone")
    return records.groupBy("LocationID").agg(last).select("zone.*")


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """JSON-line requests as text fields; a line that is no JSON object keeps its
    text in ``malformed``."""
    with written_by("the request export", path):
        return (spark.read.schema(REQUEST_LINES).option("mode", "PERMISSIVE")
                .option("columnNameOfCorruptRecord", MALFORMED).json(path))


def write_zones(zones: DataFrame, path: str) -> None:
    (zones.select(*ZONES.fieldNames())
     .write.mode("overwrite").option("header", True).csv(path))


def write_records(df: DataFrame, path: str) -> None:
    """Records as JSON lines. Nulls are written, so every record has all keys."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_records(spark: SparkSession, path: str, schema: StructType, made_by: str,
                 array_file: bool = False) -> DataFrame:
    """JSON lines, or one array or object per file with ``array_file``.

    Malformed input raises instead of turning into null rows.
    """
    with written_by(made_by, path):
        return (spark.read.schema(schema).option("mode", "FAILFAST")
                .option("multiLine", array_file).json(path))


def read_projection(spark: SparkSession, path: str) -> LambertConic:
    """The conic system of a ``.prj`` file."""
    with written_by("the zone export", path):
        return lambert_conic(spark.read.text(path, wholetext=True).first()[0])


def literal_rows(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A few rows from the caller, e.g. one interactive request or the bands.

    Built from literals, so Catalyst knows the size and can broadcast them;
    rows shipped from Python would be a scan of unknown size.
    """
    structs = [F.struct(*[F.lit(value).cast(f.dataType).alias(f.name)
                          for value, f in zip(row, schema.fields, strict=True)]) for row in rows]
    if not structs:
        return spark.createDataFrame([], schema)
    return spark.range(1).select(F.inline(F.array(*structs)))
