"""The log of landed files, months in mixed types, corrections by stream."""

from __future__ import annotations

import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.test_sources import counts, write_month
from tripline.sources import ledger, months
from tripline.streaming import jobs


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "source"
    folder.mkdir()
    write_month(folder, 2023, 1, rows=3)
    write_month(folder, 2023, 2, rows=4)
    return folder


def landed(spark, target):
    rows = months.read_landed(spark, target)
    assert rows.select("trip_id").distinct().count() == rows.count()
    return counts(rows)


def test_second_file_of_a_landed_month(spark, source, tmp_path):
    target = str(tmp_path / "landed")
    months.land_months(spark, str(source), target)
    write_month(source, 2023, 2, rows=5, name="late_2023-02.parquet")
    assert [(r.state, r.month_landed) for r in months.pending_files(
        spark, str(source), target).collect()] == [("new", True)]
    assert counts(months.read_all(spark, str(source), target)) == {(2023, 1): 3, (2023, 2): 9}
    assert months.land_months(spark, str(source), target) == {"2023-02": months.ADDED}
    assert months.land_months(spark, str(source), target) == {}
    assert landed(spark, target) == {(2023, 1): 3, (2023, 2): 9}
    log = ledger.entries(spark, target).collect()
    assert len(log) == 3 and len({r.landing for r in log}) == 2


def test_a_landing_that_died_before_its_log_doubles_nothing(spark, source, tmp_path, monkeypatch):
    target = str(tmp_path / "landed")
    months.land_months(spark, str(source), target)
    write_month(source, 2023, 2, rows=5, name="late_2023-02.parquet")
    write_month(source, 2023, 3, rows=6)

    def dies(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(ledger, "append", dies)
        with pytest.raises(KeyboardInterrupt):
            months.land_months(spark, str(source), target)
    expected = {(2023, 1): 3, (2023, 2): 9, (2023, 3): 6}
    assert landed(spark, target) == expected
    months.land_months(spark, str(source), target)
    assert landed(spark, target) == expected
    assert months.land_months(spark, str(source), target) == {}


def test_late_file_does_not_open_the_others(spark, source, tmp_path):
    target = str(tmp_path / "landed")
    months.land_months(spark, str(source), target)
    (source / "trips_2023-02.parquet").write_bytes(b"no parquet")
    write_month(source, 2023, 2, rows=5, name="late_2023-02.parquet")
    assert months.land_months(spark, str(source), target) == {"2023-02": months.ADDED}
    assert landed(spark, target) == {(2023, 1): 3, (2023, 2): 9}


def test_replacing_drops_files_that_are_gone(spark, source, tmp_path):
    target = str(tmp_path / "landed")
    write_month(source, 2023, 2, rows=5, name="late_2023-02.parquet")
    months.land_months(spark, str(source), target)
    os.remove(source / "trips_2023-02.parquet")
    write_month(source, 2023, 2, rows=7, name="late_2023-02.parquet")
    state = {r.path.rsplit("/", 1)[1]: r.state for r in months.pending_files(
        spark, str(source), target).collect()}
    assert state == {"late_2023-02.parquet": "changed"}
    assert months.land_months(spark, str(source), target, replace=True) == {"2023-02": months.REPLACED}
    assert landed(spark, target) == {(2023, 1): 3, (2023, 2): 7}
    write_month(source, 2023, 2, rows=4)  # its rows went with the replaced month
    assert months.land_months(spark, str(source), target) == {"2023-02": months.ADDED}
    assert landed(spark, target) == {(2023, 1): 3, (2023, 2): 11}


def test_months_landed_without_a_log_tell_their_files(spark, source, tmp_path):
    target = str(tmp_path / "landed")
    months.read_months(spark, str(source)).write.partitionBy("year", "month").parquet(target)
    assert months.land_months(spark, str(source), target) == {}
    write_month(source, 2023, 1, rows=2, name="more_2023-01.parquet")
    assert months.land_months(spark, str(source), target) == {"2023-01": months.ADDED}
    assert landed(spark, target) == {(2023, 1): 5, (2023, 2): 4}


def test_months_that_store_ids_in_three_types(spark, source, tmp_path):
    write_month(source, 2023, 3, rows=5, ids=pa.float64())
    write_month(source, 2023, 4, rows=6, ids=pa.int32(), name="odd {x} 2023-04.parquet")
    trips = months.read_months(spark, str(source))
    assert counts(trips) == {(2023, 1): 3, (2023, 2): 4, (2023, 3): 5, (2023, 4): 6}
    assert dict(trips.dtypes)["DOLocationID"] == "int"
    gaps = {r.month: r.n for r in trips.groupBy("month").agg(
        F.count_if(F.col("DOLocationID").isNull()).alias("n")).collect()}
    assert gaps == {1: 1, 2: 1, 3: 1, 4: 1}
    months.land_months(spark, str(source), str(tmp_path / "landed"))
    assert landed(spark, str(tmp_path / "landed")) == counts(trips)


def test_one_scan_for_each_way_of_storing(spark, source):
    for month in range(3, 9):
        write_month(source, 2023, month, ids=pa.float64() if month % 2 else pa.int32())
    files = sorted(str(f) for f in source.glob("*.parquet"))
    groups = months.by_storage(spark, files)
    assert sorted(len(part) for _, part in groups) == [3, 5]  # int and long read alike
    assert sorted(f for _, part in groups for f in part) == files


def test_nan_is_a_gap_and_half_an_id_an_error(spark, tmp_path):
    frame = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "PULocationID double")
    column = months._number("PULocationID", frame.schema[0].dataType)
    assert [r[0] for r in frame.select(column).collect()] == [1, None, None]
    broken = spark.createDataFrame([(1.5,)], "PULocationID double")
    with pytest.raises(Exception, match="no id"):
        broken.select(column).collect()


def corrected(spark, target):
    rows = jobs.read_corrected(spark, target)
    assert rows.select("trip_id").distinct().count() == rows.count()
    return {(r.year, r.month): (r.n, r.d) for r in rows.groupBy("year", "month").agg(
        F.count("*").alias("n"), F.max("delivery").alias("d")).collect()}


def test_corrected_months_replace_their_partition_once(spark, tmp_path):
    """Restarts, a replayed batch, a delivery over several batches, late and empty ones."""
    source, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def deliver(name, month, rows, ids=pa.int64(), file=None):
        (source / name).mkdir(parents=True, exist_ok=True)
        return write_month(source / name, 2023, month, rows=rows, ids=ids, name=file)

    def run():
        jobs.stream_corrections(spark, str(source), target, state, files_per_batch=1).awaitTermination()

    deliver("d1", 1, 4)
    deliver("d1", 1, 5, file="second_2023-01.parquet")
    deliver("d1", 2, 6)
    run()
    first = {(2023, 1): (7, "d1"), (2023, 2): (5, "d1")}  # a row of each file lacks a zone
    assert corrected(spark, target) == first
    run()
    assert corrected(spark, target) == first
    new = deliver("d2", 2, 9, ids=pa.float64())
    run()
    expected = {(2023, 1): (7, "d1"), (2023, 2): (8, "d2")}
    assert corrected(spark, target) == expected
    again = spark.createDataFrame([(f"file://{new}",)], "path string")
    jobs.correct_months(again, str(source), target)
    deliver("d1", 2, 20, file="stale_2023-02.parquet")
    run()
    assert corrected(spark, target) == expected
    deliver("d3", 2, 1)  # its only trip lacks a zone
    run()
    assert corrected(spark, target) == {(2023, 1): (7, "d1")}
