"""What the physical plans must and must not contain."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from tripline.operators import bands, distance, evaluate, hotspots, polygons, sampling
from tripline.operators.clean import clean_trips
from tripline.plans import adapters
from tripline.plans.queries import QUERIES
from tripline.sources import months
from tripline.sources.files import literal_rows
from tripline.sources.schemas import BANDS, RINGS
from tripline.sources.session import pin


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def trips(spark, sf_dir):
    return adapters.trips_from_events(adapters.table(pin(spark), sf_dir, "events"))


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """Trips as Parquet months, for plans over real scans."""
    path = str(tmp_path_factory.mktemp("plans") / "trips_2024-01.parquet")
    (adapters.trips_from_events(adapters.table(spark, sf_dir, "events")).drop("trip_id")
     .withColumn("PULocationID", F.col("PULocationID").cast("long"))
     .withColumn("DOLocationID", F.col("DOLocationID").cast("long"))
     .withColumn("unused", F.lit("x")).write.parquet(path))
    return months.read_months(spark, path)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_products(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for node in ("Python", "Pandas", "CartesianProduct", "NestedLoopJoin", "RDDScan"):
        assert node not in text, f"{node} in {name}"


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(clean_trips(stored))
    pushed = re.search(r"PushedFilters: (.*)", text).group(1)
    for part in ("GreaterThan(trip_distance,0.0)", "LessThan(trip_distance,100.0)",
                 "IsNotNull(PULocationID)", "IsNotNull(DOLocationID)"):
        assert part in pushed
    assert "unused" not in re.search(r"ReadSchema: (.*)", text).group(1)
    assert "Exchange" not in text


def test_landed_months_prune_partitions(spark, sf_dir, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "landed")
    trips = adapters.trips_from_orders(adapters.table(spark, sf_dir, "orders"))
    for month in ("1996-01", "1996-02"):
        (trips.filter(F.date_format("tpep_pickup_datetime", "yyyy-MM") == month)
         .write.parquet(f"{source}/trips_{month}.parquet"))
    months.land_months(spark, source, target)
    text = plan(months.read_landed(spark, target).filter("year = 1996 and month = 2")
                .select("trip_distance"))
    assert re.search(r"PartitionFilters: .*year.* = 1996.*month.* = 2", text)
    assert re.search(r"ReadSchema: struct<trip_distance:double>", text)


def test_hotspots_plan(spark, trips):
    text = plan(hotspots.hotspots(clean_trips(trips), adapters.zones(spark)))
    assert "BroadcastHashJoin" in text and text.count("TakeOrderedAndProject (") == 1
    assert "partial_count" in text and "partial_max_by" in text


def test_zone_lookup_outgrows_broadcast(spark, trips):
    """Past the size threshold the same join shuffles instead."""
    small = plan(distance.zone_distance(clean_trips(trips), adapters.zones(spark)))
    assert small.count("BroadcastHashJoin Inner") >= 2 and "hashpartitioning" not in small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        large = distance.zone_distance(clean_trips(trips), adapters.zones(spark))
        assert "BroadcastHashJoin" not in plan(large) and "SortMergeJoin" in plan(large)
        assert large.count() == 815
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_banded_samples_cut_groups_before_the_shuffle(trips):
    errors = evaluate.with_abs_error(adapters.closed_form(clean_trips(trips, "trip_id")))
    text = plan(bands.banded_samples(errors, "trip_id"))
    assert re.search(r"row_number\(\), 5, Partial", text)
    assert len(re.findall(r"\d+\) Exchange", text)) == 1


@pytest.mark.parametrize("n", [5, 1000, 5000])
def test_group_limit_for_any_n(spark, trips, n):
    """Each task passes on at most n rows a group, whatever the session's default was."""
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "3")
    pin(spark)
    text = plan(bands.first_per_group(trips, "PULocationID", ["trip_distance", "trip_id"], n))
    assert re.search(rf"row_number\(\), {n}, Partial", text)
    assert len(re.findall(r"\d+\) Exchange", text)) == 1


def test_union_of_bands_reads_once(spark, stored):
    errors = evaluate.with_abs_error(adapters.closed_form(clean_trips(stored, "trip_id")))
    assert plan(bands.banded_samples_union(errors, "trip_id")).count(") Scan parquet") == 1


def test_hot_zone_is_split_when_the_lookup_shuffles(spark):
    """A third of all trips start in one zone; past broadcast size the join splits it."""
    trips = spark.range(0, 600_000, 1, 24).selectExpr(
        "id AS trip_id", "CASE WHEN id % 3 = 0 THEN 7 ELSE CAST(id % 263 + 1 AS int) END AS PULocationID",
        "CAST(id % 257 + 1 AS int) AS DOLocationID")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = distance.zone_distance(trips, adapters.zones(spark))
        assert joined.count() == 600_000
        executed = joined.groupBy("PULocationID").count()
        rows = {r.PULocationID: r["count"] for r in executed.collect()}
        assert rows[7] >= 200_000 and "skew" in plan(executed).lower()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_band_table_is_broadcast(spark, trips):
    table = literal_rows(spark, bands.BANDS, BANDS)
    text = plan(bands.band_join(clean_trips(trips), table))
    assert "BroadcastHashJoin Inner" in text and "hashpartitioning" not in text


def test_split_is_narrow(trips):
    train, test = sampling.train_test_split(clean_trips(trips, "trip_id"), "trip_id")
    assert "Exchange" not in plan(train) + plan(test)


def test_large_sample_stays_spread(spark):
    """Rows below the cut pass as they are, over all cores; only those at it are ranked."""
    df = spark.range(0, 1_000_000, 1, 16)
    sample = sampling.first_by_hash(df, "id", 150_000)
    sizes = [r["count"] for r in
             sample.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 150_000 and len(sizes) >= 8 and max(sizes) < 24_000


def test_centroids_shuffle_vertices_once(spark):
    rings = spark.createDataFrame([(1, 1, 1, 0, 0.0, 0.0)], RINGS)
    text = plan(polygons.polygon_centroids(rings))
    assert "Join" not in text
    # vertices by block, pieces by ring, rings by zone
    assert len(re.findall(r"\d+\) Exchange", text)) == 3


def test_edges_shuffle_vertices_twice(spark):
    """By range before they are written, then by ring and share, whatever the gaps."""
    rings = spark.createDataFrame([(1, 1, 1, s, 0.0, 0.0) for s in (0, 1, 10**12, -10**15)], RINGS)
    text = plan(polygons.ring_edges(rings))
    assert "Union" not in text
    assert text.count("hashpartitioning(LocationID") <= 3  # vertices, their heads, heads by ring
    assert len(re.findall(r"\) Window", text)) == 2


def test_a_third_of_vertices_in_one_ring_spreads(spark):
    rings = spark.range(300_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 ELSE CAST(id % 997 + 2 AS int) END AS LocationID",
        "1 AS part_id", "1 AS ring_id", "id AS seq", "cos(id) AS x", "sin(id) AS y")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edges = polygons.ring_edges(rings)
        hot = (edges.filter("LocationID = 1").groupBy(F.spark_partition_id().alias("p")).count()
               .collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r["count"] for r in hot) == 100_000
    assert max(r["count"] for r in hot) < 40_000
