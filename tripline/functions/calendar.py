"""Trip durations and calendar features.

Trip times are wall-clock values (TIMESTAMP_NTZ). Sessions pin
``spark.sql.session.timeZone`` to UTC, so an epoch difference never jumps at a
daylight-saving change.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def duration_minutes(pickup: Column | str, dropoff: Column | str) -> Column:
    """Minutes between two times, counted in whole seconds (fractions drop)."""
    return (F.unix_timestamp(dropoff) - F.unix_timestamp(pickup)) / F.lit(60.0)


def pickup_hour(pickup: Column | str) -> Column:
    """Hour of day, 0 to 23."""
    return F.hour(pickup)


def pickup_dow(pickup: Column | str) -> Column:
    """Day of week with Sunday = 1 and Saturday = 7."""
    return F.dayofweek(pickup)
