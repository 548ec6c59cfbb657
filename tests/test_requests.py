from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tripline.operators import requests
from tripline.sources.files import literal_rows
from tripline.sources.schemas import FEATURES, REQUEST

TEXT = "id int, " + ", ".join(f"{c} string" for c in FEATURES)


def test_valid_and_rejected(spark):
    rows = [
        (1, "5.5", "237", "236", "17", "3"), (2, "abc", "1", "1", "1", "1"),
        (3, None, "", "1", "24", "0"), (4, "1", "1", "1", "0", "7"), (5, "1", "1", "1", "-1", "8"),
        (6, "NaN", "1", "1", "1", "1"), (7, "Infinity", "1", "1", "1", "1"),
        (8, "1", "9999999999", "1", "1", "1"), (9, " 2.5 ", " 7", "8 ", "23", "1"),
        (10, "1", "1", None, "1", "1"),
    ]
    df = spark.createDataFrame(rows, TEXT)
    valid = requests.valid_requests(df, "id")
    assert [(f.name, f.dataType) for f in valid.schema][1:] == [
        (f.name, f.dataType) for f in REQUEST]
    assert sorted(r.id for r in valid.collect()) == [1, 4, 9]
    rejected = {r.id: r for r in requests.rejected_requests(df, "id").collect()}
    assert {i: r.first_invalid for i, r in rejected.items()} == {
        2: "trip_distance", 3: "trip_distance", 5: "pickup_hour", 6: "trip_distance",
        7: "trip_distance", 8: "PULocationID", 10: "DOLocationID"}
    assert rejected[3].all_invalid == "trip_distance,PULocationID,pickup_hour,pickup_dow"
    assert rejected[3].DOLocationID == "1"  # kept as received


def test_reply_echoes_the_request(spark):
    request = (5.5, 237, 236, 17, 3)
    scored = literal_rows(spark, [request], REQUEST).withColumns(
        {"id": F.lit(1), "prediction": F.lit(21.4567)})
    reply = requests.replies(scored, "id").first()
    assert reply.predicted_duration_mins == 21.46 and tuple(reply.inputs) == request
    parsed = json.loads(requests.replies_json(scored, "id").first().reply)
    assert parsed == {"predicted_duration_mins": 21.46,
                      "inputs": dict(zip(FEATURES, request, strict=True))}


def test_literal_rows_check_types(spark):
    with pytest.raises(Exception):
        literal_rows(spark, [("far", 1, 1, 1, 1)], REQUEST).collect()
