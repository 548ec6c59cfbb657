"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Floats are rounded here, for comparison across engines; the operators return
them in full unless rounding is their definition.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.functions.display import trip_label
from tripline.functions.keys import content_key
from tripline.operators import (
    bands, clean, distance, evaluate, model, polygons, requests, sampling, zones,
)
from tripline.operators import hotspots as spots
from tripline.plans import adapters
from tripline.sources import files, ledger, months, published
from tripline.sources.schemas import (
    AUDIT, BANDS, FEATURES, HOTSPOTS, LABEL, METRICS, REQUEST, SAMPLES, TABLES, TRIP_FILES,
)
from tripline.sources.session import pin, scratch, settle
from tripline.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
KEY = "trip_id"
SAMPLE_ROWS = 500

QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register under the function's name, with session settings pinned."""
    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(pin(spark), sf_dir)
    QUERIES[build.__name__] = run
    return run


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.table(spark, sf_dir, "events")


def _trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.trips_from_events(_events(spark, sf_dir))


def _clean(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    return clean.clean_trips(_trips(spark, sf_dir), *keep)


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.closed_form(_clean(spark, sf_dir, KEY))


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- cleaning -------------------------------------------------------------

@query
def clean_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_clean(spark, sf_dir, KEY), 4, "trip_distance", LABEL)


@query
def clean_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_audit(_trips(spark, sf_dir))


# --- hotspots and zones ---------------------------------------------------

def _hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.hotspots(_clean(spark, sf_dir), adapters.zone_feed(spark), order="record")


@query
def hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_hotspots(spark, sf_dir), 6, "latitude", "longitude")


@query
def hotspots_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spots.hotspots_raw(_clean(spark, sf_dir))


@query
def hotspot_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    # thresholds scaled to the test tables, so that both classes occur
    markers = spots.hotspot_markers(_hotspots(spark, sf_dir), expected=120, high=60)
    return _rounded(markers, 6, "latitude", "longitude", "radius")


@query
def zone_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones.zone_map(adapters.zone_records(_events(spark, sf_dir)), "record_id")


@query
def zone_map_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = zones.zone_map(adapters.zone_records(_events(spark, sf_dir)), "record_id")
    return zones.zone_map_entries(rows)


# --- distance -------------------------------------------------------------

@query
def zone_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    estimated = distance.zone_distance(_clean(spark, sf_dir, KEY), adapters.zones(spark))
    return estimated.select(KEY, "PULocationID", "DOLocationID",
                            F.round("trip_distance", 4).alias("trip_distance"),
                            "estimated_miles")


@query
def zone_distance_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    estimated = distance.zone_distance_audit(_clean(spark, sf_dir, KEY), adapters.zones(spark))
    return estimated.select(KEY, "PULocationID", "DOLocationID", "is_estimable",
                            "estimated_miles")


# --- samples and splits ---------------------------------------------------

@query
def train_test_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (sampling.split(_clean(spark, sf_dir, KEY), KEY).groupBy("side")
            .agg(F.count("*").alias("trips"), F.sum(KEY).alias("key_sum")))


@query
def content_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A split on content: trips alike in zones, hour and day share a side."""
    trips = _clean(spark, sf_dir)
    keyed = trips.withColumn("content", content_key(*FEATURES[1:]))
    return (sampling.split(keyed, "content").groupBy("side", "pickup_dow")
            .agg(F.count("*").alias("trips")))


@query
def exact_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = sampling.first_by_hash(_trips(spark, sf_dir), KEY, SAMPLE_ROWS, seed="42")
    return sample.select(KEY, "PULocationID", "DOLocationID",
                         F.round("trip_distance", 4).alias("trip_distance"))


# --- evaluation (closed-form predictor) -----------------------------------

def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.metrics_record(evaluate.regression_metrics(_predicted(spark, sf_dir)))


def _samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bands.banded_samples(evaluate.with_abs_error(_predicted(spark, sf_dir)), KEY)


@query
def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.metrics_display(_metrics(spark, sf_dir))


@query
def error_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.error_margin(_predicted(spark, sf_dir), KEY)


@query
def banded_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_samples(spark, sf_dir), 4, "trip_distance")


@query
def banded_samples_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bands.banded_samples_union(evaluate.with_abs_error(_predicted(spark, sf_dir)), KEY)
    return _rounded(rows, 4, "trip_distance")


@query
def band_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Band table joined by range: trips and mean error per band, all trips. The
    last band is open."""
    table = files.literal_rows(spark, [*bands.BANDS, (5, 10.0, float("inf"))], BANDS)
    errors = evaluate.with_abs_error(_predicted(spark, sf_dir))
    return bands.band_join(errors, table).groupBy("band").agg(
        F.count("*").alias("trips"),
        F.count_if(F.col("abs_error") < bands.MAX_SAMPLE_ERROR).alias("close_trips"),
        F.round(F.avg("abs_error"), 4).alias("mean_error"))


@query
def sample_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bands.numbered(_samples(spark, sf_dir), ["band", "rn"])
    return rows.select("idx", KEY, trip_label(F.col("idx"), F.col("trip_distance")).alias("label"))


@query
def actual_vs_predicted_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.chart_line(_predicted(spark, sf_dir), KEY)


@query
def actual_vs_predicted_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.chart_scatter(_predicted(spark, sf_dir), KEY)


# --- requests -------------------------------------------------------------

def _requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.requests_from_events(_events(spark, sf_dir))


@query
def validate_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.valid_requests(_requests(spark, sf_dir), KEY)


@query
def rejected_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.rejected_requests(_requests(spark, sf_dir), KEY)


@query
def request_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies as JSON text, from the closed-form predictor."""
    valid = requests.valid_requests(_requests(spark, sf_dir), KEY)
    return requests.replies_json(adapters.closed_form(valid), KEY)


def _estimated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distance.estimated_requests(_requests(spark, sf_dir), adapters.zones(spark))


@query
def estimated_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests without a distance are estimated first, then all are answered by
    the closed-form predictor."""
    valid = requests.valid_requests(_estimated(spark, sf_dir), KEY)
    return _flat_replies(requests.replies(adapters.closed_form(valid), KEY))


@query
def estimated_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.rejected_requests(_estimated(spark, sf_dir), KEY)


def _flat_replies(rows: DataFrame) -> DataFrame:
    return rows.select(KEY, "predicted_duration_mins", *[f"inputs.{c}" for c in FEATURES])


# --- polygons -------------------------------------------------------------

@query
def ring_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    rings = adapters.rings_from_customers(adapters.table(spark, sf_dir, "customer"))
    return polygons.ring_edges(rings).select(
        "LocationID", "part_id", "ring_id", "seq", "x", "y", "x1", "y1")


@query
def polygon_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rings = adapters.rings_from_customers(adapters.table(spark, sf_dir, "customer"))
    return _rounded(polygons.polygon_centroids(rings), 6, "longitude", "latitude", "area")


@query
def large_ring_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rings that grow with the table, one of them with a third of all vertices."""
    rings = adapters.rings_from_events(_events(spark, sf_dir))
    return _rounded(polygons.polygon_centroids(rings), 6, "longitude", "latitude", "area")


@query
def project_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    projected = polygons.project_vertices(adapters.vertices_from_events(_events(spark, sf_dir)))
    return projected.select("seq", F.round("x", 7).alias("longitude"),
                            F.round("y", 7).alias("latitude"))


@query
def projected_by_wkt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices through two systems read from files: one with two parallels in feet,
    one with a single parallel in metres."""
    vertices, rows = adapters.vertices_from_events(_events(spark, sf_dir)), []
    for name, text in adapters.PROJECTIONS.items():
        path = scratch(spark, f"prj-{name}")
        spark.range(1).select(F.lit(text)).write.text(path)
        rows.append(polygons.project_vertices(vertices, files.read_projection(spark, path)).select(
            "seq", F.lit(name).alias("system"), F.round("x", 7).alias("longitude"),
            F.round("y", 7).alias("latitude")))
    return rows[0].unionByName(rows[1])


@query
def zone_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone dimension from projected polygons: reproject, then centroids."""
    customers = adapters.table(spark, sf_dir, "customer")
    table = polygons.zone_table(adapters.projected_rings_from_customers(customers),
                                adapters.zone_names_from_customers(customers))
    return _rounded(table, 6, "longitude", "latitude")


# --- files ----------------------------------------------------------------

def _stage(trips: DataFrame, folder: str, name: str = "trips") -> None:
    """Write trips as one folder per month, ``<name>_YYYY-MM.parquet``."""
    (trips.withColumn("file", F.format_string(
        f"{name}_%04d-%02d.parquet", F.year("tpep_pickup_datetime"),
        F.month("tpep_pickup_datetime")))
     # one month may hold most rows: rebalance splits it, and joins small ones
     .hint("rebalance", "file").write.mode("append").partitionBy("file").parquet(folder))


def _orders(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    return adapters.trips_from_orders(adapters.table(spark, sf_dir, "orders").where(where))


def _month_files(spark: SparkSession, sf_dir: str) -> str:
    source = scratch(spark, "months")
    _stage(_orders(spark, sf_dir), source)
    return source


@query
def month_of_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips per month as the file names tell it, and how many times disagree."""
    trips = months.read_months(spark, _month_files(spark, sf_dir))
    agrees = ((F.col("year") == F.year("tpep_pickup_datetime"))
              & (F.col("month") == F.month("tpep_pickup_datetime")))
    return trips.groupBy("year", "month").agg(
        F.count("*").alias("trips"), F.count_if(~agrees).alias("other_month"))


@query
def monthly_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months landed twice; the second time nothing is left to do."""
    source, target = _month_files(spark, sf_dir), scratch(spark, "landed")
    months.land_months(spark, source, target)
    months.land_months(spark, source, target)
    return clean.clean_audit(months.read_landed(spark, target), "year", "month")


@query
def landed_and_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months before 1998 have landed, the rest wait: the union holds each once."""
    source, target = _month_files(spark, sf_dir), scratch(spark, "landed")
    early = months.read_months(spark, source).filter("year < 1998")
    early.write.partitionBy("year", "month").parquet(target)
    return months.read_all(spark, source, target).groupBy("year", "month").agg(
        F.count("*").alias("trips"), F.count_distinct("trip_id").alias("ids"))


@query
def late_file_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the trips come in second files of their months, after the first
    have landed; a third landing finds nothing to do."""
    source, target = scratch(spark, "months"), scratch(spark, "landed")
    _stage(_orders(spark, sf_dir, "o_orderkey % 10 < 8"), source)
    months.land_months(spark, source, target)
    _stage(_orders(spark, sf_dir, "o_orderkey % 10 >= 8"), source, "late")
    for _ in range(2):
        months.land_months(spark, source, target)
    log = ledger.entries(spark, target).groupBy("year", "month").agg(
        F.count_distinct("landing").alias("landings"))
    return months.read_landed(spark, target).groupBy("year", "month").agg(
        F.count("*").alias("trips"), F.count_distinct("trip_id").alias("ids")).join(
        log, ["year", "month"])


@query
def mixed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months that store zone ids as int, as long and, having gaps, as double."""
    source = scratch(spark, "mixed")
    trips = _orders(spark, sf_dir).withColumn("DOLocationID", F.when(
        F.col("DOLocationID") % 50 != 0, F.col("DOLocationID")))
    kind = (F.year("tpep_pickup_datetime") * 12 + F.month("tpep_pickup_datetime")) % 3
    for number, stored in enumerate(("int", "long", "double")):
        ids = {c: F.col(c).cast(stored) for c in ("PULocationID", "DOLocationID")}
        if stored == "double":
            ids["DOLocationID"] = F.coalesce(ids["DOLocationID"], F.lit(float("nan")))
        _stage(trips.where(kind == number).withColumns(ids), source)
    return months.read_months(spark, source).groupBy("year", "month").agg(
        F.count("*").alias("trips"), F.sum("PULocationID").alias("pickup_sum"),
        F.sum("DOLocationID").alias("dropoff_sum"),
        F.count_if(F.col("DOLocationID").isNull()).alias("gaps"))


@query
def published_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hotspots and metrics published twice, first from a tenth of the trips; a reader
    finds the second version of both."""
    out, predicted = scratch(spark, "published"), _predicted(spark, sf_dir)
    for part in (predicted.where(f"{KEY} % 10 = 0"), predicted):
        def write(folder: str, part: DataFrame = part) -> None:
            files.write_records(spots.hotspots(part, adapters.zone_feed(spark), order="record"),
                                f"{folder}/hotspots")
            files.write_records(evaluate.metrics_record(evaluate.regression_metrics(part)),
                                f"{folder}/metrics")
        published.publish(spark, out, write)
    number, folder = published.version_of(spark, out)
    ranked = files.read_records(spark, f"{folder}/hotspots", HOTSPOTS, "the trip job")
    metrics = files.read_records(spark, f"{folder}/metrics", METRICS, "the trip job")
    return ranked.select("LocationID", "zone", "trip_count", F.lit(number).alias("version"),
                         metrics.select("RMSE").scalar().alias("RMSE"))


@query
def json_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hotspots through JSON, zones through CSV, joined after reading back."""
    spots_path, zones_path = scratch(spark, "hotspots"), scratch(spark, "zones")
    files.write_records(_hotspots(spark, sf_dir), spots_path)
    files.write_zones(adapters.zone_feed(spark).drop("record"), zones_path)
    ranked = files.read_records(spark, spots_path, HOTSPOTS, "the trip job")
    boroughs = files.read_zones(spark, zones_path).select("LocationID", "borough")
    return _rounded(ranked.join(boroughs, "LocationID"), 6, "latitude", "longitude")


@query
def metrics_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "metrics")
    files.write_records(_metrics(spark, sf_dir), path)
    return files.read_records(spark, path, METRICS, "the trip job")


@query
def samples_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "samples")
    files.write_records(_samples(spark, sf_dir).select(*SAMPLES.fieldNames()), path)
    return _rounded(files.read_records(spark, path, SAMPLES, "the trip job"), 4, "trip_distance")


# --- model ----------------------------------------------------------------

_models: dict[tuple[str, str], PipelineModel] = {}


def trained(spark: SparkSession, sf_dir: str) -> tuple[PipelineModel, DataFrame]:
    """The test side, and the forest: trained, saved and loaded once per application."""
    train, test = sampling.train_test_split(_clean(spark, sf_dir, KEY), KEY)
    at = (spark.sparkContext.applicationId, sf_dir)
    if at not in _models:
        path = scratch(spark, "model")
        model.save(model.fit(model.training_table(train, KEY)), path)
        _models[at] = model.load(spark, path)
    return _models[at], test


@query
def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, test = trained(spark, sf_dir)
    return evaluate.metrics_record(evaluate.regression_metrics(model.predict(fitted, test)))


@query
def model_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, test = trained(spark, sf_dir)
    return bands.banded_samples(evaluate.with_abs_error(model.predict(fitted, test)), KEY)


@query
def feature_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, _ = trained(spark, sf_dir)
    return model.feature_importances(spark, fitted)


@query
def score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, _ = trained(spark, sf_dir)
    return requests.replies_json(
        model.score_requests(fitted, _requests(spark, sf_dir), KEY), KEY)


def _differing(left: DataFrame, right: DataFrame) -> Column:
    """Rows of either side without an equal row on the other, as one number."""
    return left.exceptAll(right).unionAll(right.exceptAll(left)).agg(F.count("*")).scalar()


@query
def model_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts about the forest that hold whatever trees it grew."""
    fitted, test = trained(spark, sf_dir)
    path = scratch(spark, "model-copy")
    model.save(fitted, path)
    predicted = settle(model.predict(fitted, test).select(KEY, LABEL, "prediction"), "predicted")
    again = model.predict(model.load(spark, path), test).select(KEY, LABEL, "prediction")
    train, _ = sampling.train_test_split(_clean(spark, sf_dir, KEY), KEY)
    labels = train.agg(F.min(LABEL).alias("low"), F.max(LABEL).alias("high")).first()
    ours = evaluate.regression_metrics(predicted).first()
    judge = RegressionEvaluator(labelCol=LABEL, predictionCol="prediction")
    theirs = [judge.setMetricName(m).evaluate(predicted) for m in ("rmse", "r2", "mae")]
    weights = model.feature_importances(spark, fitted)
    try:
        model.load(spark, f"{path}-absent")
        missing = "found"
    except files.MissingArtefact as error:
        missing = str(error).split("; ")[-1]
    scored = model.score_requests(fitted, _requests(spark, sf_dir), KEY)
    return spark.range(1).select(
        scored.agg(F.count("*")).scalar().alias("scored"),
        predicted.agg(F.count_if(~F.col("prediction").between(labels["low"], labels["high"])))
        .scalar().alias("out_of_range"),
        _differing(predicted, again).alias("reload_mismatches"),
        weights.agg(F.count("*")).scalar().alias("importances"),
        weights.agg(F.count_if(F.col("importance") < 0)).scalar().alias("negative_importances"),
        weights.agg(F.round(F.sum("importance"), 6)).scalar().alias("importance_sum"),
        F.lit(sum(abs(a - b) >= 5e-7 for a, b in zip(ours, theirs, strict=True)))
        .alias("metric_mismatches"),
        F.lit(ours["R2_Score"] > 0.5).alias("r2_above_half"),
        F.lit(missing).alias("missing_artefact"))


# --- streams --------------------------------------------------------------

def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.file_stream(spark, f"{sf_dir}/events.parquet", TABLES["events"])


def _read_replies(spark: SparkSession, target: str) -> DataFrame:
    inputs = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in REQUEST.fields)
    return _flat_replies(spark.read.schema(f"{KEY} bigint, predicted_duration_mins double, "
                              f"inputs struct<{inputs}>").parquet(target))


@query
def stream_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed replies from the closed-form predictor."""
    target = scratch(spark, "replies")
    valid = requests.valid_requests(
        adapters.requests_from_events(_event_stream(spark, sf_dir)), KEY)
    jobs.stream_replies(adapters.closed_form(valid), KEY, target,
                        f"{target}-checkpoint").awaitTermination()
    return _read_replies(spark, target)


@query
def stream_estimated_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed requests without a distance get the estimate on their way."""
    target = scratch(spark, "estimated")
    asked = distance.estimated_requests(
        adapters.requests_from_events(_event_stream(spark, sf_dir)), adapters.zones(spark))
    valid = requests.valid_requests(asked, KEY)
    jobs.stream_replies(adapters.closed_form(valid), KEY, target,
                        f"{target}-checkpoint").awaitTermination()
    return _read_replies(spark, target)


@query
def stream_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch(spark, "rejected")
    jobs.stream_rejected(adapters.requests_from_events(_event_stream(spark, sf_dir)), KEY,
                         target, f"{target}-checkpoint").awaitTermination()
    schema = requests.rejected_requests(_requests(spark, sf_dir), KEY).schema
    return spark.read.schema(schema).parquet(target)


@query
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, _ = trained(spark, sf_dir)
    target = scratch(spark, "scores")
    jobs.stream_scores(fitted, adapters.requests_from_events(_event_stream(spark, sf_dir)), KEY,
                       target, f"{target}-checkpoint").awaitTermination()
    return _read_replies(spark, target)


@query
def stream_model_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The streamed scores beside the batch scores of the same requests."""
    fitted, _ = trained(spark, sf_dir)
    streamed = stream_score(spark, sf_dir)
    batch = _flat_replies(requests.replies(
        model.score_requests(fitted, _requests(spark, sf_dir), KEY), KEY))
    return spark.range(1).select(
        streamed.agg(F.count("*")).scalar().alias("scored"),
        _differing(streamed, batch).alias("mismatches"))


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch(spark, "ingested")
    jobs.stream_ingest(adapters.trips_from_events(_event_stream(spark, sf_dir)), [KEY],
                       target, f"{target}-checkpoint").awaitTermination()
    landed = spark.read.schema(_clean(spark, sf_dir, KEY).schema).parquet(target)
    return _rounded(landed, 4, "trip_distance", LABEL)


@query
def stream_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly files cleaned by a stream that runs twice: the second adds nothing."""
    source, target = _month_files(spark, sf_dir), scratch(spark, "cleaned-months")
    for _ in range(2):
        jobs.stream_months(spark, source, target, f"{target}-checkpoint").awaitTermination()
    schema = "trip_id string, trip_distance double, trip_duration_mins double, year int, month int"
    return (spark.read.schema(schema).parquet(target).groupBy("year", "month")
            .agg(F.count("*").alias("trips"), F.round(F.sum("trip_distance"), 3).alias("miles"),
                 F.round(F.sum(LABEL), 3).alias("minutes")))


def _outcomes(spark: SparkSession, target: str, *more: str) -> DataFrame:
    """Replies and rejects of ``stream_answers``, flat."""
    inputs = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in REQUEST.fields)
    extra = "".join(f", {c} int" for c in more)
    answered = spark.read.schema(f"{KEY} bigint, predicted_duration_mins double, "
                                 f"inputs struct<{inputs}>{extra}, batch int").parquet(f"{target}/replies")
    rejected = spark.read.schema(f"{KEY} bigint, first_invalid string, batch int").parquet(
        f"{target}/rejected")
    return answered.select(KEY, "predicted_duration_mins", F.lit(None).cast("string").alias(
        "first_invalid"), *more).unionByName(rejected.select(KEY, "first_invalid"),
                                             allowMissingColumns=True)


@query
def stream_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies and rejects from one reading of the stream; its batch is then replayed."""
    target = scratch(spark, "answers")
    asked = adapters.requests_from_events(_event_stream(spark, sf_dir))
    jobs.stream_answers(asked, KEY, adapters.closed_form, target,
                        f"{target}-checkpoint").awaitTermination()
    jobs.answer_batch(_requests(spark, sf_dir), 0, KEY, adapters.closed_form, target)
    return _outcomes(spark, target)


@query
def stream_model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of even ids come while the first version of a published predictor
    counts, the others after the second: distance + 4, then distance + 6 minutes."""
    source, target, out = (scratch(spark, n) for n in ("asked", "versions", "predictors"))

    def predictor(rows: DataFrame) -> DataFrame:
        number, folder = published.version_of(spark, out)
        minutes = spark.read.schema("minutes double").json(folder).scalar()
        return rows.withColumns({"prediction": F.col("trip_distance") + minutes,
                                 "model_version": F.lit(number)})

    for minutes, part in ((4.0, "event_id % 2 = 0"), (6.0, "event_id % 2 = 1")):
        published.publish(spark, out, lambda folder, m=minutes: files.write_records(
            spark.range(1).select(F.lit(m).alias("minutes")), folder))
        _events(spark, sf_dir).where(part).write.mode("append").parquet(source)
        asked = adapters.requests_from_events(jobs.file_stream(spark, source, TABLES["events"]))
        jobs.stream_answers(asked, KEY, predictor, target, f"{target}-checkpoint").awaitTermination()
    return _outcomes(spark, target, "model_version")


@query
def stream_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audits of several micro-batches, added up, beside the rows that they wrote."""
    source, target = _month_files(spark, sf_dir), scratch(spark, "audited")
    files_of_a_batch = jobs.file_stream(spark, source, TRIP_FILES, files_per_batch=50)
    trips = months.month_rows(files_of_a_batch, source)
    jobs.stream_audited(trips, [KEY], f"{target}/trips", f"{target}/audits",
                        f"{target}-checkpoint").awaitTermination()
    written = spark.read.schema("trip_id string, batch int").parquet(f"{target}/trips")
    return spark.read.schema(AUDIT).parquet(f"{target}/audits").agg(
        *(F.sum(c).alias(c) for c in AUDIT.fieldNames())).withColumn(
        "written", written.agg(F.count("*")).scalar())


@query
def stream_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second delivery corrects the months from 2000 on, in other types; the stream
    runs before, after and once more."""
    source, target = scratch(spark, "deliveries"), scratch(spark, "corrected")

    def run() -> None:
        jobs.stream_corrections(spark, source, target, f"{target}-checkpoint").awaitTermination()

    _stage(_orders(spark, sf_dir), f"{source}/2024-01-05")
    run()
    fixed = _orders(spark, sf_dir).where(F.year("tpep_pickup_datetime") >= 2000).withColumns(
        {"trip_distance": F.col("trip_distance") / 2} | {
            c: F.col(c).cast("double") for c in ("PULocationID", "DOLocationID")})
    _stage(fixed, f"{source}/2024-02-05")
    run()
    run()
    return jobs.read_corrected(spark, target).groupBy("year", "month").agg(
        F.count("*").alias("trips"), F.count_distinct("trip_id").alias("ids"),
        F.round(F.sum("trip_distance"), 3).alias("miles"), F.max("delivery").alias("delivery"))
