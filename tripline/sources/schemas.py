"""Explicit schemas. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampNTZType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


# Zone ids are LONG here because published months differ (int32 or int64) and
# the Parquet reader widens but never narrows; ``read_months`` casts them.
TRIP_FILES = _struct(
    tpep_pickup_datetime=TimestampNTZType(),
    tpep_dropoff_datetime=TimestampNTZType(),
    trip_distance=DoubleType(),
    PULocationID=LongType(),
    DOLocationID=LongType(),
)

MONTHS = _struct(year=IntegerType(), month=IntegerType())

ZONES = _struct(
    LocationID=IntegerType(),
    zone=StringType(),
    borough=StringType(),
    longitude=DoubleType(),
    latitude=DoubleType(),
)

ZONE_NAMES = _struct(LocationID=IntegerType(), zone=StringType(), borough=StringType())

REQUEST = _struct(
    trip_distance=DoubleType(),
    PULocationID=IntegerType(),
    DOLocationID=IntegerType(),
    pickup_hour=IntegerType(),
    pickup_dow=IntegerType(),
)

# Requests as they arrive: text, to be checked.
REQUEST_TEXT = _struct(request_id=StringType(),
                       **{name: StringType() for name in REQUEST.fieldNames()})

# With the text of a line that is no JSON object.
MALFORMED = "malformed"
REQUEST_LINES = StructType([*REQUEST_TEXT.fields, StructField(MALFORMED, StringType(), True)])

FEATURES = REQUEST.fieldNames()
LABEL = "trip_duration_mins"

SAMPLES = StructType(REQUEST.fields + [StructField(LABEL, DoubleType(), True)])

HOTSPOTS = _struct(
    LocationID=IntegerType(),
    zone=StringType(),
    latitude=DoubleType(),
    longitude=DoubleType(),
    trip_count=LongType(),
)

METRICS = _struct(RMSE=DoubleType(), R2_Score=DoubleType(), MAE=DoubleType())

AUDIT = _struct(rows_in=LongType(), dropped_duration=LongType(), dropped_distance=LongType(),
                dropped_missing=LongType(), rows_out=LongType())

# The columns read from the test tables.
TABLES = {
    "events": _struct(event_id=LongType(), ts=TimestampNTZType(), user_id=LongType(),
                      value=DoubleType()),
    "orders": _struct(o_orderkey=LongType(), o_custkey=LongType(), o_totalprice=DoubleType(),
                      o_orderdate=TimestampNTZType()),
    "customer": _struct(c_custkey=LongType()),
}

BANDS = _struct(band=IntegerType(), lo=DoubleType(), hi=DoubleType())

IMPORTANCES = _struct(feature=StringType(), importance=DoubleType())

RINGS = _struct(
    LocationID=IntegerType(),
    part_id=IntegerType(),
    ring_id=IntegerType(),
    seq=LongType(),
    x=DoubleType(),
    y=DoubleType(),
)
