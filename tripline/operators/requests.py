"""Prediction requests: validation and replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripline.sources.schemas import FEATURES, MALFORMED, REQUEST

# Set by ``distance.estimated_requests``.
UNKNOWN_ZONE = "unknown_zone"

# Form bounds of the two calendar fields.
HOURS = (0, 23)
DAYS = (1, 7)


def _checks() -> dict[str, Column]:
    """Validity per field, over columns already cast; null means not a value."""
    distance = F.col("__trip_distance")
    return {
        "trip_distance": distance.isNotNull() & ~F.isnan(distance)
                         & (F.abs(distance) < float("inf")),
        "PULocationID": F.col("__PULocationID").isNotNull(),
        "DOLocationID": F.col("__DOLocationID").isNotNull(),
        "pickup_hour": F.coalesce(F.col("__pickup_hour").between(*HOURS), F.lit(False)),
        "pickup_dow": F.coalesce(F.col("__pickup_dow").between(*DAYS), F.lit(False)),
    }


def check_requests(requests: DataFrame) -> DataFrame:
    """Cast the five text fields; add the first and all invalid field names.

    try_cast, since a plain cast of bad text raises under ANSI. Narrow; the
    text stays in the row for the report of rejected requests.
    """
    cast = requests.withColumns(
        {f"__{f.name}": F.col(f.name).try_cast(f.dataType) for f in REQUEST.fields})
    failed = [F.when(~ok, F.lit(name)) for name, ok in _checks().items()]
    if MALFORMED in requests.columns:  # such a line has no fields to name
        broken = F.col(MALFORMED).isNotNull()
        failed = [F.when(broken, F.lit(MALFORMED)),
                  *(F.when(~broken, name) for name in failed)]
    if UNKNOWN_ZONE in requests.columns:  # no estimate: the zone is at fault, not the distance
        failed = [F.concat(UNKNOWN_ZONE, F.lit(" unknown")), *failed]
    return cast.withColumns({"first_invalid": F.coalesce(*failed),
                             "all_invalid": F.concat_ws(",", *failed)})


def checked_valid(checked: DataFrame, key: str) -> DataFrame:
    """Of checked requests those that pass every check, typed and ready to score."""
    return checked.filter("first_invalid is null").select(
        key, *[F.col(f"__{name}").alias(name) for name in FEATURES])


def checked_rejects(checked: DataFrame, key: str) -> DataFrame:
    """Of checked requests those that fail, as received, with the first and all invalid
    fields; a line that is no JSON object with its text."""
    text = [MALFORMED] if MALFORMED in checked.columns else []
    return checked.filter("first_invalid is not null").select(
        key, *FEATURES, *text, "first_invalid", "all_invalid")


def valid_requests(requests: DataFrame, key: str) -> DataFrame:
    """Typed requests that pass every check, ready to score."""
    return checked_valid(check_requests(requests), key)


def rejected_requests(requests: DataFrame, key: str) -> DataFrame:
    """Failing requests as received, with the first and all invalid fields."""
    return checked_rejects(check_requests(requests), key)


def replies(scored: DataFrame, key: str, *more: str) -> DataFrame:
    """Rounded prediction with the request echoed in ``inputs``, and columns ``more``."""
    return scored.select(key, F.round("prediction", 2).alias("predicted_duration_mins"),
                         F.struct(*FEATURES).alias("inputs"), *more)


def replies_json(scored: DataFrame, key: str) -> DataFrame:
    """The reply as JSON text."""
    return replies(scored, key).select(
        key, F.to_json(F.struct("predicted_duration_mins", "inputs")).alias("reply"))
