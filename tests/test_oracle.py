"""Every registered query against its SQL, and against the published counts."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.oracle_check import connect, differences
from tripline.plans import adapters, oracle, queries
from tripline.sources.session import pin

# the training-data operators have their own tests
QUERIES, ORACLE = queries.QUERIES, oracle.ORACLE

ROWS_ONLY = {"model_metrics", "model_samples", "feature_importance", "score_requests",
             "stream_score"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, sf_dir, name):
    assert differences(entry.queries()[name](spark, sf_dir), duck, ORACLE[name]) == []


def test_only_forest_queries_lack_sql():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(ORACLE) <= set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["LocationID", "zone", "latitude", "longitude", "trip_count"]
    assert df.count() == 15


def test_expected_counts(spark, sf_dir):
    """Values worked out beforehand for the smallest scale."""
    q = {name: build(spark, sf_dir) for name, build in QUERIES.items()
         if name in ("clean_trips", "clean_audit", "hotspots", "regression_metrics",
                     "banded_samples", "zone_distance", "train_test_split",
                     "validate_requests", "rejected_requests")}
    audit = q["clean_audit"].first()
    assert (audit.rows_in, audit.rows_out) == (1000, 897)
    assert (audit.rows_in - audit.dropped_duration - audit.dropped_distance
            - audit.dropped_missing) == audit.rows_out
    sums = q["clean_trips"].selectExpr(
        "round(sum(trip_duration_mins), 2) m", "sum(pickup_hour) h", "sum(pickup_dow) d",
        "round(sum(trip_distance), 3) miles", "count_if(trip_distance = 4.0) four").first()
    assert (sums.m, sums.h, sums.d, sums.miles, sums.four) == (12945.38, 10316, 3557, 9173.392, 12)
    hot = q["hotspots"].collect()
    assert sum(r.trip_count for r in hot) == 854
    assert (hot[0].LocationID, hot[0].trip_count) == (99, 74)
    metrics = q["regression_metrics"].first()
    assert (metrics.RMSE, metrics.R2_Score, metrics.MAE) == (3.02, 0.9027, 2.49)
    assert metrics.r2_text == "90.3%"
    assert q["banded_samples"].count() == 20
    assert q["zone_distance"].count() == 815
    assert {r.side: r.trips for r in q["train_test_split"].collect()} == {"train": 702, "test": 195}
    assert q["validate_requests"].count() == 886
    rejected = {r.first_invalid: r["count"]
                for r in q["rejected_requests"].groupBy("first_invalid").count().collect()}
    assert rejected == {"trip_distance": 52, "DOLocationID": 18, "pickup_hour": 23,
                        "pickup_dow": 21}


def test_adapter_trips_cover_the_edges(spark, sf_dir):
    trips = adapters.trips_from_events(adapters.table(pin(spark), sf_dir, "events"))
    seen = trips.selectExpr("count_if(trip_distance = 0) zero", "count_if(trip_distance = 150) far",
                            "count_if(PULocationID is null) gap",
                            "count_if(PULocationID = 264) unknown").first()
    assert all(v > 0 for v in seen)
