from __future__ import annotations

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tripline.operators import evaluate, model, sampling
from tripline.operators.clean import clean_trips
from tripline.plans import adapters, trip_job
from tripline.plans.adapters import requests_from_events
from tripline.operators.requests import rejected_requests
from tripline.sources.files import MissingArtefact, read_records, read_requests
from tripline.sources.schemas import FEATURES, HOTSPOTS, LABEL, METRICS, SAMPLES
from tripline.sources.session import pin, settle
from tripline.streaming import jobs
from tests.test_sources import write_month


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    return adapters.table(pin(spark), sf_dir, "events")


@pytest.fixture(scope="module")
def sides(events):
    cleaned = clean_trips(adapters.trips_from_events(events), "trip_id")
    train, test = sampling.train_test_split(cleaned, "trip_id")
    return model.training_table(train, "trip_id"), settle(test, "test")


@pytest.fixture(scope="module")
def forest(sides):
    return model.fit(sides[0], trees=5, depth=6)


def test_training_table_does_not_depend_on_the_input_layout(sides):
    layouts = [model.training_table(sides[0].repartition(p), "trip_id", rows=150) for p in (1, 3)]
    placed = [sorted((r.p, r.trip_id) for r in t.select(
        F.element_at(F.split(F.input_file_name(), "part-"), -1).substr(1, 5).alias("p"), "trip_id")
        .collect()) for t in layouts]
    assert placed[0] == placed[1] and len({p for p, _ in placed[0]}) == 5  # 690 to 750 rows
    a, b = (model.fit(t, trees=3, depth=4) for t in layouts)
    mean = [evaluate.regression_metrics(model.predict(m, sides[1])).first().MAE for m in (a, b)]
    assert mean[0] == pytest.approx(mean[1], rel=0.01)


def test_better_than_the_mean(forest, sides):
    metrics = evaluate.regression_metrics(model.predict(forest, sides[1])).first()
    assert metrics.R2_Score > 0.5


def test_saved_and_loaded_model_agree(spark, forest, sides, tmp_path):
    path = str(tmp_path / "model")
    model.save(forest, path)
    model.save(forest, path)  # overwrites
    a, b = (sorted(model.predict(m, sides[1]).select("trip_id", "prediction").collect())
            for m in (forest, model.load(spark, path)))
    assert a == b
    with pytest.raises(MissingArtefact, match="training job"):
        model.load(spark, str(tmp_path / "none"))


def test_importances_sum_to_one(spark, forest):
    rows = model.feature_importances(spark, forest).collect()
    assert {r.feature for r in rows} == set(FEATURES)
    assert sum(r.importance for r in rows) == pytest.approx(1.0)
    assert rows[0].feature == "trip_distance"


def test_scoring_skips_invalid_requests(forest, events):
    scored = model.score_requests(forest, requests_from_events(events), "trip_id")
    assert scored.count() == 886
    assert scored.filter("prediction is null").count() == 0


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def test_stream_scores_equal_batch(spark, forest, events, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    requests_from_events(events).repartition(3).write.parquet(source)
    stream = jobs.file_stream(spark, source, requests_from_events(events).schema, files_per_batch=1)
    for _ in range(2):  # the second run finds nothing new
        run(jobs.stream_scores(forest, stream, "trip_id", target, str(tmp_path / "state")))
    batch = jobs.replies(model.score_requests(forest, requests_from_events(events), "trip_id"),
                         "trip_id")
    assert sorted(spark.read.parquet(target).collect()) == sorted(batch.collect())


def age(path, days):
    then = time.time() - days * 86_400
    os.utime(path, (then, then))


def test_late_files_count_whatever_their_age(spark, tmp_path):
    """Backfilled months and copies that keep their time are older than the newest."""
    source, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    write_month(source, 2023, 2, rows=4)
    run(jobs.stream_months(spark, str(source), target, state))
    age(write_month(source, 2023, 1, rows=3), 30)
    age(write_month(source, 2022, 1, rows=6), 400)
    write_month(source, 2023, 3, rows=5)
    run(jobs.stream_months(spark, str(source), target, state))
    got = spark.read.parquet(target).groupBy("year", "month").count().collect()
    assert {(r.year, r.month): r["count"] for r in got} == {
        (2023, 1): 2, (2022, 1): 5, (2023, 2): 3, (2023, 3): 4}


def test_late_and_malformed_requests(spark, forest, tmp_path):
    source, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    good = {"trip_distance": 5.0, "PULocationID": 237, "DOLocationID": 236, "pickup_hour": 17,
            "pickup_dow": 3}

    def ask(name, *ids, days=0):
        path = source / name
        path.write_text("".join(json.dumps(good | {"request_id": i}) + "\n" for i in ids)
                        + ("{nope\n" if days else ""))
        age(path, days)

    def answer():
        requests = jobs.request_stream(spark, str(source))
        run(jobs.stream_scores(forest, requests, "request_id", target, state))
        run(jobs.stream_rejected(requests, "request_id", target + "-bad", state + "-bad"))
        return sorted(r.request_id for r in spark.read.parquet(target).collect())

    ask("a.json", "a", "b")
    assert answer() == ["a", "b"]
    ask("b.json", "c", days=30)
    ask("c.json", "d", days=400)
    ask("d.json", "e")
    assert answer() == ["a", "b", "c", "d", "e"]
    streamed = spark.read.parquet(target + "-bad")
    batch = rejected_requests(read_requests(spark, str(source)), "request_id")
    assert batch.columns == streamed.columns
    for rows in (streamed.collect(), batch.collect()):
        assert [(r.malformed, r.first_invalid, r.all_invalid) for r in rows] == [
            ("{nope", "malformed", "malformed")] * 2


def test_stream_ingest_counts_each_file_once(spark, tmp_path):
    source, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    write_month(source, 2023, 1, rows=3)
    write_month(source, 2023, 2, rows=4)

    def ingest():
        run(jobs.stream_months(spark, str(source), target, state))
        got = spark.read.parquet(target).groupBy("year", "month").count().collect()
        return {(r.year, r.month): r["count"] for r in got}

    assert ingest() == {(2023, 1): 2, (2023, 2): 3}
    assert ingest() == {(2023, 1): 2, (2023, 2): 3}
    write_month(source, 2023, 3, rows=10)
    assert ingest() == {(2023, 1): 2, (2023, 2): 3, (2023, 3): 9}


def test_whole_job(spark, events, tmp_path):
    trips, zones = adapters.trips_from_events(events), adapters.zones(spark)
    paths = trip_job.run(spark, trips, "trip_id", str(tmp_path), zones, trees=4, depth=5)
    hot = read_records(spark, paths["hotspots"], HOTSPOTS, "job").collect()
    assert len(hot) == 15
    assert [r.trip_count for r in hot] == sorted((r.trip_count for r in hot), reverse=True)
    metrics = read_records(spark, paths["metrics"], METRICS, "job").collect()
    assert len(metrics) == 1 and 0 < metrics[0].RMSE < 30
    samples = read_records(spark, paths["samples"], SAMPLES, "job")
    assert 0 < samples.count() <= 20
    assert samples.filter(F.col("trip_distance").between(3, 10)).count() == samples.count()
    audit = spark.read.json(paths["audit"]).first()
    assert (audit.rows_in, audit.rows_out) == (1000, 897)
    assert spark.read.json(paths["actual_vs_predicted_line"]).count() == 100
    assert 150 < spark.read.json(paths["actual_vs_predicted_scatter"]).count() < 230
    assert spark.read.json(paths["feature_importance"]).count() == len(FEATURES)
    loaded = model.load(spark, paths["model"])
    assert model.predict(loaded, clean_trips(trips)).select(LABEL, "prediction").count() == 897


def test_job_without_zones_keeps_ids(spark, events, tmp_path):
    work = tmp_path / "work"
    paths = trip_job.run(spark, adapters.trips_from_events(events), "trip_id",
                         str(tmp_path / "out"), trees=2, depth=3, work=str(work))
    assert not work.exists()  # settled copies go with the job
    assert set(spark.read.json(paths["hotspots"]).columns) == {"PULocationID", "trip_count"}
