"""Zone coordinates by id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.sources.files import read_zones


def zone_map(records: DataFrame, order: str) -> DataFrame:
    """One row per zone id: text id, lat, lon. The last record by ``order`` wins.

    ``order`` must be a number that is unique per record. Two max_by on plain
    columns keep the aggregation hashed and combined before the shuffle; a
    struct would force a sort of all records.
    """
    return (
        records.groupBy("LocationID")
        .agg(F.max_by("latitude", order).alias("lat"), F.max_by("longitude", order).alias("lon"))
        .select(F.col("LocationID").cast("string").alias("zone_id"),
                F.col("lat").cast("double"), F.col("lon").cast("double"))
    )


def zone_map_of_file(spark: SparkSession, path: str) -> DataFrame:
    """``zone_map`` of zone files; on a repeated id the later line wins."""
    rows = read_zones(spark, path).withColumn("__one", F.lit(1))
    return zone_map(rows, "__one")


def zone_map_entries(zone_rows: DataFrame) -> DataFrame:
    """The rows of ``zone_map`` as text, ``{id: {lat, lon}}``, one entry per row."""
    return zone_rows.select("zone_id", F.to_json(
        F.create_map("zone_id", F.struct("lat", "lon"))).alias("entry"))
