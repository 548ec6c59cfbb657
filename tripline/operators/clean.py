"""Cleaning and features of raw trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tripline.functions.calendar import duration_minutes, pickup_dow, pickup_hour
from tripline.sources.schemas import FEATURES, LABEL

# The open intervals outside which a trip is an outlier.
MINUTES = (2, 120)
MILES = (0, 100)


def _within(c: Column, bounds: tuple[float, float]) -> Column:
    return (c > bounds[0]) & (c < bounds[1])


def add_duration(trips: DataFrame) -> DataFrame:
    return trips.withColumn(
        LABEL, duration_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime"))


def add_calendar(trips: DataFrame) -> DataFrame:
    return trips.withColumns({
        "pickup_hour": pickup_hour("tpep_pickup_datetime"),
        "pickup_dow": pickup_dow("tpep_pickup_datetime"),
    })


def clean_trips(trips: DataFrame, *keep: str,
                minutes: tuple[float, float] = MINUTES,
                miles: tuple[float, float] = MILES) -> DataFrame:
    """Trips without outliers or gaps: five features and the duration.

    ``keep`` names further columns to carry along (a row key, say). One narrow
    stage. The distance range and the null tests on the ids reach the Parquet
    scan; the duration is computed, so its range cannot.
    """
    columns = [*FEATURES, LABEL]
    return (
        add_calendar(
            add_duration(trips)
            .filter(F.col("PULocationID").isNotNull() & F.col("DOLocationID").isNotNull())
            .filter(_within(F.col("trip_distance"), miles))
            .filter(_within(F.col(LABEL), minutes)))
        .select(*keep, *columns)
        .dropna(how="any", subset=columns)
    )


def _audit(minutes: tuple[float, float], miles: tuple[float, float]) -> list[Column]:
    """Counts over rows with duration and calendar; the rules apply in order."""
    columns = [*FEATURES, LABEL]
    duration_ok = F.coalesce(_within(F.col(LABEL), minutes), F.lit(False))
    distance_ok = F.coalesce(_within(F.col("trip_distance"), miles), F.lit(False))
    complete = F.lit(True)
    for c in columns:
        complete = complete & F.col(c).isNotNull()
    return [
        F.count("*").alias("rows_in"),
        F.count_if(~duration_ok).alias("dropped_duration"),
        F.count_if(duration_ok & ~distance_ok).alias("dropped_distance"),
        F.count_if(duration_ok & distance_ok & ~complete).alias("dropped_missing"),
        F.count_if(duration_ok & distance_ok & complete).alias("rows_out"),
    ]


def clean_audit(trips: DataFrame, *by: str,
                minutes: tuple[float, float] = MINUTES,
                miles: tuple[float, float] = MILES) -> DataFrame:
    """Rows in, rows each rule drops, rows out; one row, or one per ``by`` group.
    One pass.

    Rules apply in order: duration, distance, missing values; a row counts for
    the first rule it fails.
    """
    return add_calendar(add_duration(trips)).groupBy(*by).agg(*_audit(minutes, miles))


def clean_observed(trips: DataFrame, *keep: str,
                   minutes: tuple[float, float] = MINUTES,
                   miles: tuple[float, float] = MILES) -> tuple[DataFrame, Observation]:
    """``clean_trips``, and the audit of the pass that computes it.

    Every row is read for the audit, so no rule is pushed into the scan. The
    counts are there once the rows have been written or counted.
    """
    audit = Observation("clean_audit")
    seen = add_calendar(add_duration(trips)).observe(audit, *_audit(minutes, miles))
    columns = [*FEATURES, LABEL]
    rows = (seen.filter(_within(F.col("trip_distance"), miles) & _within(F.col(LABEL), minutes))
            .select(*keep, *columns).dropna(how="any", subset=columns))
    return rows, audit
