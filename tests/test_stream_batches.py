"""Streams that write by micro-batch: answers, model versions, audits; and publication."""

from __future__ import annotations

import threading
import time

import pytest
from pyspark.sql import functions as F

from tripline.operators import clean, model, sampling
from tripline.plans import adapters
from tripline.sources import files, published
from tripline.sources.files import MissingArtefact
from tripline.sources.schemas import AUDIT, TABLES
from tripline.sources.session import pin
from tripline.streaming import jobs

KEY = "trip_id"


@pytest.fixture
def events(spark, sf_dir):
    return adapters.table(pin(spark), sf_dir, "events")


def stage(events, path, part):
    events.where(part).coalesce(1).write.mode("append").parquet(path)


def outcomes(spark, target):
    replies = spark.read.parquet(f"{target}/replies")
    rejected = spark.read.parquet(f"{target}/rejected")
    assert replies.select(KEY).distinct().count() == replies.count()
    return replies.count(), rejected.count()


def test_answers_from_one_reading(spark, events, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    stage(events, source, "event_id % 2 = 0")
    stage(events, source, "event_id % 2 = 1")

    def run():
        asked = adapters.requests_from_events(
            jobs.file_stream(spark, source, TABLES["events"], files_per_batch=1))
        query = jobs.stream_answers(asked, KEY, adapters.closed_form, target, state)
        query.awaitTermination()
        return query.recentProgress

    read = sum(p.numInputRows for p in run())
    assert read == events.count() == sum(outcomes(spark, target))
    once = outcomes(spark, target)
    run()
    assert outcomes(spark, target) == once


def test_batch_that_died_between_its_outputs(spark, events, tmp_path, monkeypatch):
    """The replies are out, the rejects are not: the replay doubles no reply."""
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    stage(events, source, "true")
    asked = lambda: adapters.requests_from_events(
        jobs.file_stream(spark, source, TABLES["events"]))

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(jobs, "checked_rejects", dies)
        with pytest.raises(Exception, match="lost"):
            jobs.stream_answers(asked(), KEY, adapters.closed_form, target, state).awaitTermination()
    assert spark.read.parquet(f"{target}/replies").count() > 0
    jobs.stream_answers(asked(), KEY, adapters.closed_form, target, state).awaitTermination()
    assert sum(outcomes(spark, target)) == events.count()


def test_running_stream_takes_up_a_new_forest(spark, events, tmp_path):
    source, target, state, out = (str(tmp_path / n) for n in ("in", "out", "state", "forests"))
    trips = clean.clean_trips(adapters.trips_from_events(events), KEY)
    train, _ = sampling.train_test_split(trips, KEY)

    def publish(trees):
        fitted = model.fit(model.training_table(train, KEY), trees=trees, depth=3)
        return published.publish(spark, out, lambda folder: model.save(fitted, f"{folder}/model"))

    assert publish(2) == 1
    stage(events, source, "event_id % 2 = 0")
    asked = adapters.requests_from_events(jobs.file_stream(spark, source, TABLES["events"]))
    query = jobs.stream_answers(asked, KEY, jobs.published_predictor(spark, out), target, state,
                                drain=False)
    try:
        query.processAllAvailable()
        assert publish(3) == 2
        stage(events, source, "event_id % 2 = 1")
        query.processAllAvailable()
    finally:
        query.stop()
    replies = spark.read.parquet(f"{target}/replies")
    by_version = {(r[0], r[1]) for r in replies.select(F.col(KEY) % 2, "model_version").distinct().collect()}
    assert by_version == {(0, 1), (1, 2)}
    last = model.load(spark, f"{published.version_of(spark, out)[1]}/model")
    batch = model.score_requests(last, adapters.requests_from_events(
        events.where("event_id % 2 = 1")), KEY).select(KEY, F.round("prediction", 2).alias("p"))
    both = batch.join(replies, KEY)
    assert both.count() == batch.count() == both.where("p = predicted_duration_mins").count()


def test_audits_of_batches_add_up(spark, events, tmp_path):
    source, target, audits, state = (str(tmp_path / n) for n in ("in", "out", "audits", "state"))
    for part in range(3):
        stage(events, source, f"event_id % 3 = {part}")
    for _ in range(2):
        trips = adapters.trips_from_events(
            jobs.file_stream(spark, source, TABLES["events"], files_per_batch=1))
        jobs.stream_audited(trips, [KEY], target, audits, state).awaitTermination()
    found = spark.read.parquet(audits)
    assert found.count() == 3
    total = found.agg(*(F.sum(c).alias(c) for c in AUDIT.fieldNames())).first()
    assert total == clean.clean_audit(adapters.trips_from_events(events)).first()
    assert spark.read.parquet(target).count() == total.rows_out


def test_readers_always_find_one_whole_version(spark, tmp_path):
    out = str(tmp_path / "published")
    with pytest.raises(MissingArtefact, match="run the trip job"):
        published.version_of(spark, out, "the trip job")

    def write(n):
        def both(folder):
            files.write_records(spark.range(1).select(F.lit(n).alias("n")), f"{folder}/a")
            time.sleep(0.2)
            files.write_records(spark.range(1).select(F.lit(n).alias("n")), f"{folder}/b")
        return both

    published.publish(spark, out, write(1))
    seen, stop = set(), threading.Event()

    def reads():
        while not stop.is_set():
            number, folder = published.version_of(spark, out)
            seen.add((number, *(spark.read.schema("n int").json(f"{folder}/{x}").first().n for x in "ab")))

    reader = threading.Thread(target=reads)
    reader.start()
    try:
        for n in (2, 3, 4):
            assert published.publish(spark, out, write(n), keep=3) == n
    finally:
        stop.set()
        reader.join()
    assert seen <= {(n, n, n) for n in (1, 2, 3, 4)} and len(seen) > 1
    assert sorted(p.name for p in (tmp_path / "published" / "versions").iterdir()) == [
        f"{n:012d}" for n in (2, 3, 4)]


def test_failed_job_publishes_nothing(spark, tmp_path):
    out = str(tmp_path / "published")
    published.publish(spark, out, lambda folder: files.write_records(spark.range(1), folder))

    def dies(folder):
        files.write_records(spark.range(5), folder)
        raise RuntimeError("half done")

    with pytest.raises(RuntimeError):
        published.publish(spark, out, dies)
    assert published.version_of(spark, out)[0] == 1
    assert len(list((tmp_path / "published" / "versions").iterdir())) == 1
    assert published.publish(spark, out, lambda folder: files.write_records(spark.range(2), folder)) == 3
