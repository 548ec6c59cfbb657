from __future__ import annotations

import json
import shutil
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tripline.operators.clean import clean_trips
from tripline.sources import files, months
from tripline.sources.schemas import HOTSPOTS, METRICS, SAMPLES, ZONES
from tripline.sources.session import settle, shared_dir
from tripline.streaming import jobs


def write_month(folder, year, month, rows=3, ids=pa.int64(), name=None):
    """One published-style file: five used columns and one more."""
    start = [datetime(year, month, 1 + i % 28, 8) for i in range(rows)]
    table = pa.table({
        "VendorID": pa.array([1] * rows),
        "tpep_pickup_datetime": pa.array(start, pa.timestamp("us")),
        "tpep_dropoff_datetime": pa.array([t.replace(minute=20) for t in start], pa.timestamp("us")),
        "trip_distance": pa.array([2.5] * rows),
        "PULocationID": pa.array([132] * rows, ids),
        "DOLocationID": pa.array([None if i == 0 else 1 for i in range(rows)], ids),
    })
    path = folder / (name or f"trips_{year}-{month:02d}.parquet")
    pq.write_table(table, path)
    return path


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "source"
    folder.mkdir()
    write_month(folder, 2023, 1, rows=3, ids=pa.int64())
    write_month(folder, 2023, 2, rows=4, ids=pa.int32())
    write_month(folder, 2024, 11, rows=5)
    return folder


def counts(df):
    return {(r.year, r.month): r["count"] for r in df.groupBy("year", "month").count().collect()}


def test_months_with_different_id_widths(spark, source):
    trips = months.read_months(spark, str(source))
    assert counts(trips) == {(2023, 1): 3, (2023, 2): 4, (2024, 11): 5}
    assert dict(trips.dtypes)["PULocationID"] == "int"
    assert dict(trips.dtypes)["tpep_pickup_datetime"] == "timestamp_ntz"
    assert clean_trips(trips).count() == 9  # the first row of each month lacks its dropoff zone


def test_exact_copies_keep_separate_ids(spark, source):
    trips = months.read_months(spark, str(source))
    assert trips.select("trip_id").distinct().count() == trips.count() == 12


def test_month_folders_read_like_files(spark, source, tmp_path):
    folder = tmp_path / "folders" / "trips_2023-05.parquet"
    folder.mkdir(parents=True)
    write_month(folder, 2023, 5, name="part-0.parquet")
    assert counts(months.read_months(spark, str(tmp_path / "folders"))) == {(2023, 5): 3}


def test_landing_is_idempotent(spark, source, tmp_path):
    target = str(tmp_path / "landed")
    assert months.land_months(spark, str(source), target) == {
        "2023-01": "landed", "2023-02": "landed", "2024-11": "landed"}
    assert months.land_months(spark, str(source), target) == {}
    write_month(source, 2023, 3, rows=6)
    assert months.land_months(spark, str(source), target) == {"2023-03": "landed"}
    landed = months.read_landed(spark, target)
    expected = {(2023, 1): 3, (2023, 2): 4, (2023, 3): 6, (2024, 11): 5}
    assert counts(landed) == expected
    assert counts(landed.filter("year = 2023 and month = 2")) == {(2023, 2): 4}


def test_replacing_a_month_does_not_double_it(spark, source, tmp_path):
    target = str(tmp_path / "landed")
    months.land_months(spark, str(source), target)
    write_month(source, 2023, 2, rows=9)
    assert months.land_months(spark, str(source), target) == {}
    months.land_months(spark, str(source), target, replace=True)
    assert counts(months.read_landed(spark, target)) == {(2023, 1): 3, (2023, 2): 9, (2024, 11): 5}


def test_bad_month(spark, source, tmp_path):
    (source / "trips_2023-02.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        months.land_months(spark, str(source), str(tmp_path / "all"))
    target = str(tmp_path / "landed")
    state = months.land_months(spark, str(source), target, isolate=True)
    assert state["2023-01"] == state["2024-11"] == "landed"
    assert state["2023-02"].startswith("failed: ")
    assert counts(months.read_landed(spark, target)) == {(2023, 1): 3, (2024, 11): 5}
    write_month(source, 2023, 2, rows=4)
    assert months.land_months(spark, str(source), target, isolate=True) == {"2023-02": "landed"}


def test_landed_months_skip_source_files(spark, source, tmp_path):
    """A landed month's source is not opened again: it may even be damaged."""
    target = str(tmp_path / "landed")
    months.land_months(spark, str(source), target)
    (source / "trips_2023-01.parquet").write_bytes(b"no parquet")
    write_month(source, 2023, 7)
    assert months.land_months(spark, str(source), target) == {"2023-07": "landed"}


def test_files_without_a_month_are_reported(spark, source, tmp_path):
    write_month(source, 2023, 5, name="march.parquet")
    write_month(source, 2023, 6, name="trips_2023-6.parquet")
    state = months.land_months(spark, str(source), str(tmp_path / "landed"))
    odd = {path.rsplit("/", 1)[1] for path, outcome in state.items() if outcome == months.NO_MONTH}
    assert odd == {"march.parquet", "trips_2023-6.parquet"}
    assert sorted(state.values()).count("landed") == 3


def test_ids_stay_when_the_folder_moves(spark, source, tmp_path):
    """Also between a batch read, a landing and a stream of the same folder."""
    moved = tmp_path / "deeper" / "moved"
    shutil.copytree(source, moved)
    here, there = ({r.trip_id for r in months.read_months(spark, str(p)).collect()}
                   for p in (source, moved))
    assert here == there and len(here) == 12
    months.land_months(spark, str(moved), str(tmp_path / "landed"))
    assert {r.trip_id for r in months.read_landed(spark, str(tmp_path / "landed")).collect()} == here
    streamed = str(tmp_path / "streamed")
    jobs.stream_months(spark, str(source), streamed, str(tmp_path / "state")).awaitTermination()
    assert {r.trip_id for r in spark.read.parquet(streamed).collect()} < here


def test_landed_and_waiting_months_as_one(spark, source, tmp_path):
    target = str(tmp_path / "landed")
    months.land_months(spark, str(source), target)
    write_month(source, 2024, 12, rows=7)
    assert counts(months.read_all(spark, str(source), target)) == {
        (2023, 1): 3, (2023, 2): 4, (2024, 11): 5, (2024, 12): 7}


def test_zone_columns_go_by_name(spark, tmp_path):
    (tmp_path / "swapped.csv").write_text(
        "zone,latitude,longitude,LocationID,extra,borough\nA,40.1,-74.1,1,x,B\n")
    row = files.read_zones(spark, str(tmp_path / "swapped.csv")).first()
    assert row.asDict() == {"LocationID": 1, "zone": "A", "borough": "B", "longitude": -74.1,
                            "latitude": 40.1}
    (tmp_path / "bad.csv").write_text(
        "LocationID,zone,borough,longitude,latitude\n1,A,B,oops,40.1\n")
    with pytest.raises(Exception, match="oops|MALFORMED"):
        files.read_zones(spark, str(tmp_path / "bad.csv")).collect()
    (tmp_path / "short.csv").write_text("LocationID,zone\n1,A\n")
    with pytest.raises(ValueError, match="borough, latitude, longitude"):
        files.read_zones(spark, str(tmp_path / "short.csv"))


def test_zone_csv_round_trip(spark, tmp_path):
    zones = spark.createDataFrame([(1, 'A "quoted", name', "B", -74.174000272763, 40.69183120640153),
                                   (2, None, "C", None, 40.6)], ZONES)
    path = str(tmp_path / "zones")
    files.write_zones(zones, path)
    assert sorted(files.read_zones(spark, path).collect()) == sorted(zones.collect())


def test_json_lines_round_trip(spark, tmp_path):
    spots = spark.createDataFrame([(132, "Airport", 40.6, -73.7, 2565), (1, None, None, None, 5)],
                                  HOTSPOTS)
    path = str(tmp_path / "hotspots")
    files.write_records(spots, path)
    lines = [json.loads(line) for f in (tmp_path / "hotspots").glob("part-*")
             for line in f.read_text().splitlines()]
    assert all(set(line) == set(HOTSPOTS.fieldNames()) for line in lines)
    assert sorted(files.read_records(spark, path, HOTSPOTS, "job").collect()) == sorted(spots.collect())


def test_array_and_object_files(spark, tmp_path):
    samples = tmp_path / "samples.json"
    samples.write_text(json.dumps([
        {"trip_distance": 3.0, "PULocationID": 151, "DOLocationID": 42, "pickup_hour": 20,
         "pickup_dow": 7, "trip_duration_mins": 16.23}] * 2, indent=1))
    got = files.read_records(spark, str(samples), SAMPLES, "job", array_file=True)
    assert [tuple(r) for r in got.collect()] == [(3.0, 151, 42, 20, 7, 16.23)] * 2
    metrics = tmp_path / "metrics.json"
    metrics.write_text('{"RMSE": 4.82, "R2_Score": 0.8011, "MAE": 3.21}')
    assert tuple(files.read_records(spark, str(metrics), METRICS, "job", array_file=True).first()) == (
        4.82, 0.8011, 3.21)


def test_damaged_records_raise(spark, tmp_path):
    (tmp_path / "bad.json").write_text("{nope")
    with pytest.raises(Exception):
        files.read_records(spark, str(tmp_path / "bad.json"), METRICS, "job").collect()


def test_missing_artefact_names_the_job(spark, tmp_path):
    with pytest.raises(files.MissingArtefact, match="run the trip job first"):
        files.read_records(spark, str(tmp_path / "none"), METRICS, "the trip job")
    with pytest.raises(files.MissingArtefact, match="zone export"):
        files.read_zones(spark, str(tmp_path / "none.csv"))


def test_settle_lies_in_the_shared_folder(spark):
    df = settle(spark.range(10), "unit")
    assert df.count() == 10
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured is None or shared_dir(spark) == configured.rstrip("/")
    assert all(shared_dir(spark).removeprefix("file:") in f for f in df.inputFiles())
