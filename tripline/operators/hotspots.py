"""Busiest pickup zones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.functions.display import (
    HIGH_DEMAND_TRIPS, MAX_EXPECTED_TRIPS, demand_class, marker_radius, thousands,
)
from tripline.sources.schemas import HOTSPOTS

TOP_ZONES = 100


def trips_per_zone(trips: DataFrame) -> DataFrame:
    """Trips per pickup zone. Counts combine before the shuffle, so a zone with
    a third of all trips costs no more than any other."""
    return trips.groupBy("PULocationID").agg(F.count("*").alias("trip_count"))


def hotspots_raw(trips: DataFrame, top: int = TOP_ZONES) -> DataFrame:
    """The ``top`` zones by trips; ties go to the smaller id. No zone table."""
    return trips_per_zone(trips).orderBy(F.desc("trip_count"), "PULocationID").limit(top)


def hotspots(trips: DataFrame, zones: DataFrame, top: int = TOP_ZONES,
             order: str | None = None) -> DataFrame:
    """The top zones with name and coordinates, each once.

    The ranking comes first: a zone missing from the zone table takes its rank
    and then drops out, so the result can be shorter than ``top``. At most
    ``top`` rows enter the join, and Catalyst broadcasts by size. Of a zone
    with several records the last by ``order`` counts, or without it the last
    of the frame; only records of ranked zones are compared.
    """
    top_zones = hotspots_raw(trips, top)
    if order is None:
        zones, order = zones.withColumn("__line", F.monotonically_increasing_id()), "__line"
    matched = top_zones.join(zones, top_zones.PULocationID == zones.LocationID, "inner")
    last = F.max_by(F.struct(*HOTSPOTS.fieldNames()), order).alias("spot")
    return (matched.groupBy("LocationID").agg(last).select("spot.*")
            .orderBy(F.desc("trip_count"), "LocationID"))


def mappable(spots: DataFrame) -> DataFrame:
    """Rows that can be placed on a map: both coordinates are numbers other than 0."""
    return spots.filter("latitude is not null and latitude <> 0 and not isnan(latitude) "
                        "and longitude is not null and longitude <> 0 and not isnan(longitude)")


def hotspot_markers(spots: DataFrame, expected: int = MAX_EXPECTED_TRIPS,
                    high: int = HIGH_DEMAND_TRIPS) -> DataFrame:
    """Marker size, demand class and count text per mappable hotspot."""
    count = F.col("trip_count")
    return mappable(spots).select(
        "LocationID", "zone", "latitude", "longitude", "trip_count",
        marker_radius(count, expected).alias("radius"),
        demand_class(count, high).alias("demand"),
        F.concat(thousands(count), F.lit(" Trips")).alias("trips_text"),
    )
