from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tripline.operators import hotspots, zones
from tripline.sources import files
from tripline.sources.schemas import HOTSPOTS, ZONES


@pytest.fixture
def dimension(spark):
    return spark.createDataFrame([(i, f"Z{i}", "B", -74.0, 40.0 + i / 10) for i in range(1, 4)],
                                 ZONES)


def trips(spark, **counts):
    rows = [(int(zone[1:]),) for zone, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, "PULocationID int")


def test_ties_go_to_the_smaller_id(spark):
    got = hotspots.hotspots_raw(trips(spark, z3=2, z1=2, z2=5), top=2).collect()
    assert [(r.PULocationID, r.trip_count) for r in got] == [(2, 5), (1, 2)]


def test_unknown_zone_takes_a_rank_and_drops(spark, dimension):
    got = hotspots.hotspots(trips(spark, z264=9, z2=5, z1=3, z3=1), dimension, top=3).collect()
    assert [(r.LocationID, r.zone, r.trip_count) for r in got] == [(2, "Z2", 5), (1, "Z1", 3)]


def test_schema(spark, dimension):
    got = hotspots.hotspots(trips(spark, z1=1), dimension)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in HOTSPOTS]


def test_markers(spark):
    rows = [(1, "a", 40.7, -74.0, 1500), (2, "b", 40.7, -74.0, 1501), (3, "c", 40.7, -74.0, 3000),
            (4, "d", 40.7, -74.0, 2_500_000), (5, "e", 0.0, -74.0, 9), (6, "f", 40.7, None, 9),
            (7, "g", 40.7, -74.0, 1), (8, "h", float("nan"), -74.0, 9)]
    got = {r.LocationID: r for r in
           hotspots.hotspot_markers(spark.createDataFrame(rows, HOTSPOTS)).collect()}
    assert set(got) == {1, 2, 3, 4, 7}
    assert [got[i].demand for i in (1, 2, 3)] == ["normal", "high", "high"]
    assert [got[i].radius for i in (1, 3, 4, 7)] == [17.5, 35.0, 35.0, 5.0]
    assert got[4].trips_text == "2,500,000 Trips"


def test_zone_map_last_record_wins(spark):
    rows = [(1, 7, 40.0, -74.0), (2, 7, 41.0, -73.0), (3, 8, 42.0, -72.0)]
    records = spark.createDataFrame(
        rows, "n long, LocationID int, latitude double, longitude double").repartition(3)
    by_id = zones.zone_map(records, "n")
    assert {r.zone_id: (r.lat, r.lon) for r in by_id.collect()} == {
        "7": (41.0, -73.0), "8": (42.0, -72.0)}
    entries = {r.zone_id: r.entry for r in zones.zone_map_entries(by_id).collect()}
    assert entries == {"7": '{"7":{"lat":41.0,"lon":-73.0}}', "8": '{"8":{"lat":42.0,"lon":-72.0}}'}


def test_zone_map_of_a_file_with_a_repeated_line(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text("LocationID,zone,borough,longitude,latitude\n"
                    "1,A,X,-74.1,40.1\n2,B,X,-74.2,40.2\n1,A,X,-74.3,40.3\n")
    got = zones.zone_map_of_file(spark, str(path))
    assert {r.zone_id: (r.lat, r.lon) for r in got.collect()} == {
        "1": (40.3, -74.3), "2": (40.2, -74.2)}


def test_later_file_wins_whatever_its_size(spark, tmp_path):
    """Scans pack large files first; the path decides all the same."""
    header = "LocationID,zone,borough,longitude,latitude\n"
    more = "".join(f"{i},Z,X,-74.0,40.0\n" for i in range(10, 5000))
    for old, new in (("", more), (more, "")):
        folder = tmp_path / f"zones{len(old)}"
        folder.mkdir()
        (folder / "a.csv").write_text(header + old + "1,Old,X,-74.1,40.1\n")
        (folder / "b.csv").write_text(header + "1,New,X,-74.2,40.2\n" + new)
        got = files.read_zones(spark, str(folder))
        assert [r.zone for r in got.filter("LocationID = 1").collect()] == ["New"]
        assert got.count() == 4991


def test_repeated_zones_give_each_spot_once(spark):
    records = spark.createDataFrame(
        [(i, name, "B", -74.0, lat, n) for n, (name, lat) in enumerate([("old", 1.0), ("new", 2.0)])
         for i in range(1, 101)], "LocationID int, zone string, borough string, longitude double, "
        "latitude double, n int").repartition(5)
    got = hotspots.hotspots(trips(spark, **{f"z{i}": 1 for i in range(1, 101)}), records, order="n")
    rows = got.collect()
    assert len(rows) == 100 and {r.zone for r in rows} == {"new"}
    assert [r.LocationID for r in rows] == list(range(1, 101))


def test_one_zone_with_a_third_of_all_trips(spark, dimension):
    many = spark.range(90_000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, 2).otherwise(F.col("id") % 250 + 10)
        .cast("int").alias("PULocationID"))
    got = hotspots.hotspots(many, dimension).collect()
    assert [(r.LocationID, r.trip_count) for r in got] == [(2, 30_000)]
