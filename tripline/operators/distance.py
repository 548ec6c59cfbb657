"""Distance estimate between the pickup and dropoff zones of each trip.

``zones`` has one row per LocationID; ``zones.zone_map`` settles repeated ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripline.functions.geo import ROUTING_FACTOR, routed_miles


def _lookup(trips: DataFrame, zones: DataFrame, key: str, prefix: str, how: str) -> DataFrame:
    # No broadcast hint: Catalyst broadcasts the zone table while its measured
    # size is below the threshold, and beyond it AQE splits hot zones.
    side = zones.select(F.col("LocationID").alias(f"{prefix}_id"),
                        F.col("latitude").alias(f"{prefix}_lat"),
                        F.col("longitude").alias(f"{prefix}_lon"))
    return trips.join(side, trips[key] == side[f"{prefix}_id"], how)


def _both_ends(trips: DataFrame, zones: DataFrame, how: str) -> DataFrame:
    with_pickup = _lookup(trips, zones, "PULocationID", "pu", how)
    return _lookup(with_pickup, zones, "DOLocationID", "do", how)


def _estimate(factor: float):
    return routed_miles(F.col("pu_lat"), F.col("pu_lon"), F.col("do_lat"), F.col("do_lon"), factor)


def zone_distance(trips: DataFrame, zones: DataFrame,
                  factor: float = ROUTING_FACTOR) -> DataFrame:
    """Trips whose zones are both known, with ``estimated_miles``."""
    return (_both_ends(trips, zones, "inner")
            .select(*trips.columns, _estimate(factor).alias("estimated_miles")))


def zone_distance_audit(trips: DataFrame, zones: DataFrame,
                        factor: float = ROUTING_FACTOR) -> DataFrame:
    """All trips; ``is_estimable`` is false and the estimate null where a zone
    is unknown."""
    known = F.col("pu_id").isNotNull() & F.col("do_id").isNotNull()
    return (_both_ends(trips, zones, "left")
            .select(*trips.columns, known.alias("is_estimable"),
                    F.when(known, _estimate(factor)).alias("estimated_miles")))


def estimated_requests(requests: DataFrame, zones: DataFrame,
                       factor: float = ROUTING_FACTOR) -> DataFrame:
    """Text requests in which a missing distance is the estimate between the zones.

    Null and blank count as missing; a distance that is given stays, also a bad
    one. ``unknown_zone`` names the zone field that kept a request from its
    estimate. Batch or stream: ``zones`` is a table and joins from the left.
    """
    ids = requests.withColumns({"__pu": F.col("PULocationID").try_cast("int"),
                                "__do": F.col("DOLocationID").try_cast("int")})
    joined = _lookup(_lookup(ids, zones, "__pu", "pu", "left"), zones, "__do", "do", "left")
    missing = F.coalesce(F.trim("trip_distance"), F.lit("")) == ""
    unknown = (F.when(F.col("__pu").isNotNull() & F.col("pu_id").isNull(), "PULocationID")
               .when(F.col("__do").isNotNull() & F.col("do_id").isNull(), "DOLocationID"))
    known = F.col("pu_id").isNotNull() & F.col("do_id").isNotNull()
    distance = F.when(missing & known, _estimate(factor).cast("string")).otherwise(
        F.col("trip_distance"))
    return joined.select(*(distance.alias(c) if c == "trip_distance" else c
                           for c in requests.columns),
                         F.when(missing, unknown).alias("unknown_zone"))
