from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tripline.operators.clean import clean_audit, clean_trips
from tripline.sources.schemas import TRIP_FILES

START = datetime(2023, 1, 7, 23, 30)  # a Saturday
NAN = float("nan")


def trip(seconds=600.0, miles=3.0, pu=1, do=2, start=START):
    end = None if seconds is None else start + timedelta(seconds=seconds)
    return (start, end, miles, pu, do)


@pytest.fixture
def trips(spark):
    return lambda *rows: spark.createDataFrame(list(rows), TRIP_FILES)


def minutes(df):
    return sorted(r.trip_duration_mins for r in df.collect())


def test_duration_bounds_are_open(trips):
    df = clean_trips(trips(trip(120), trip(121), trip(7199), trip(7200), trip(-60), trip(None)))
    assert minutes(df) == [121 / 60, 7199 / 60]


def test_distance_bounds_are_open_and_nan_drops(trips):
    df = clean_trips(trips(*[trip(miles=m) for m in (0.0, 1e-9, 99.999, 100.0, NAN, None, -1.0)]))
    assert sorted(r.trip_distance for r in df.collect()) == [1e-9, 99.999]


def test_missing_ids_drop(trips):
    assert clean_trips(trips(trip(pu=None), trip(do=None), trip())).count() == 1


def test_fractions_of_seconds_drop(trips):
    start = datetime(2023, 1, 1, 0, 0, 0, 900_000)
    df = clean_trips(trips((start, datetime(2023, 1, 1, 0, 3, 0, 100_000), 1.0, 1, 2)))
    assert minutes(df) == [3.0]


def test_calendar_features(trips):
    rows = clean_trips(trips(trip(start=START), trip(start=START + timedelta(hours=1)))
                       ).orderBy("pickup_dow").collect()
    # Sunday is 1 and Saturday 7; the pickup decides, not the dropoff
    assert [(r.pickup_dow, r.pickup_hour) for r in rows] == [(1, 0), (7, 23)]


def test_wall_clock_ignores_daylight_saving(spark, trips):
    # 2023-03-12 02:30 does not exist in New York; the wall clock still counts
    df = clean_trips(trips((datetime(2023, 3, 12, 1, 30), datetime(2023, 3, 12, 3, 0), 1.0, 1, 2)))
    assert minutes(df) == [90.0]


def test_columns_and_keys(trips):
    df = clean_trips(trips(trip()).withColumn("trip_id", F.lit(7)), "trip_id")
    assert df.columns == ["trip_id", "trip_distance", "PULocationID", "DOLocationID",
                          "pickup_hour", "pickup_dow", "trip_duration_mins"]


def test_audit_counts_first_failing_rule(trips):
    row = clean_audit(trips(trip(60, 0.0), trip(None), trip(600, 0.0, pu=None), trip(pu=None),
                            trip(miles=NAN), trip(), trip())).first()
    assert row.asDict() == {"rows_in": 7, "dropped_duration": 2, "dropped_distance": 2,
                            "dropped_missing": 1, "rows_out": 2}


def test_audit_per_group_adds_up(trips):
    df = trips(trip(), trip(60), trip(miles=0.0), trip()).withColumn(
        "g", F.when(F.col("trip_distance") == 0, "a").otherwise("b"))
    got = {r.g: (r.rows_in, r.rows_out) for r in clean_audit(df, "g").collect()}
    assert got == {"a": (1, 0), "b": (3, 2)}
