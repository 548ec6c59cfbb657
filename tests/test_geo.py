from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tripline.functions.geo import NY_LONG_ISLAND_FEET as NY
from tripline.functions.geo import conic_to_lonlat, haversine_miles
from tripline.operators.distance import zone_distance, zone_distance_audit
from tripline.sources.schemas import ZONES


def forward(lon: float, lat: float) -> tuple[float, float]:
    """Textbook forward projection, for the round trip."""
    rho = NY.scale * NY.t(lat) ** NY.cone
    theta = NY.cone * math.radians(lon - NY.central_meridian)
    return (NY.false_easting + rho * math.sin(theta),
            NY.false_northing + NY.origin_radius - rho * math.cos(theta))


def test_projection_inverts(spark):
    points = [(lon / 100, lat / 100) for lon in range(-7430, -7360, 7)
              for lat in range(4045, 4095, 7)]
    rows = [(lon, lat, *forward(lon, lat)) for lon, lat in points]
    df = spark.createDataFrame(rows, "lon double, lat double, x double, y double")
    lon, lat = conic_to_lonlat(F.col("x"), F.col("y"))
    worst = df.select(F.max(F.abs(lon - F.col("lon"))), F.max(F.abs(lat - F.col("lat")))).first()
    assert max(worst) < 1e-11


def test_projection_origin(spark):
    # false easting and northing are, by definition, the origin
    df = spark.createDataFrame([(984250.0, 0.0)], "x double, y double")
    got = df.select(*conic_to_lonlat(F.col("x"), F.col("y"))).first()
    assert got[0] == pytest.approx(-74.0, abs=1e-12)
    assert got[1] == pytest.approx(40.1666666666667, abs=1e-11)


def test_haversine_known_values(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (40.7, -74.0, 40.7, -74.0),
                                (0.0, 0.0, 90.0, 0.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_miles(*map(F.col, "abcd"))).collect()]
    assert got == pytest.approx([math.pi * 3958.8, 0.0, math.pi / 2 * 3958.8])


@pytest.fixture
def zones(spark):
    return spark.createDataFrame([(1, "a", "x", -74.0, 40.7), (2, "b", "x", -73.9, 40.8)], ZONES)


def test_distance_needs_both_zones(spark, zones):
    trips = spark.createDataFrame([(1, 1, 2), (2, 2, 1), (3, 1, 1), (4, 1, 264), (5, 265, 2)],
                                  "trip_id int, PULocationID int, DOLocationID int")
    known = {r.trip_id: r.estimated_miles for r in zone_distance(trips, zones).collect()}
    assert known[1] == known[2] > 0 and known[3] == 0.0 and set(known) == {1, 2, 3}
    audit = {r.trip_id: r for r in zone_distance_audit(trips, zones).collect()}
    assert [audit[i].is_estimable for i in range(1, 6)] == [True, True, True, False, False]
    assert audit[1].estimated_miles == known[1] and audit[4].estimated_miles is None
