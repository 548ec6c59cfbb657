"""The jobs from the command line; see ``python -m tripline --help``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from tripline.functions.geo import NY_LONG_ISLAND_FEET
from tripline.operators import distance, model, polygons, requests
from tripline.plans import trip_job
from tripline.sources import files, months, published
from tripline.sources.schemas import RINGS, ZONE_NAMES
from tripline.sources.session import pin, remove, settle, work_folder
from tripline.streaming import jobs


def land(spark: SparkSession, args: argparse.Namespace) -> None:
    state = months.land_months(spark, args.source, args.target, replace=args.replace,
                               isolate=args.isolate)
    for month, outcome in state.items():
        print(month, outcome)
    if any(outcome == months.NO_MONTH or outcome.startswith("failed") for outcome in state.values()):
        raise SystemExit("some months failed, or files could not be placed")


def zones(spark: SparkSession, args: argparse.Namespace) -> None:
    vertices = spark.read.schema(RINGS).parquet(args.vertices)
    names = spark.read.schema(ZONE_NAMES).parquet(args.names)
    system = files.read_projection(spark, args.prj) if args.prj else NY_LONG_ISLAND_FEET
    files.write_zones(polygons.zone_table(vertices, names, system), args.out)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    table = files.read_zones(spark, args.zones) if args.zones else None
    trips = months.read_landed(spark, args.trips)
    if args.publish:
        print(published.publish(spark, args.out, lambda folder: trip_job.run(
            spark, trips, "trip_id", folder, table)))
    else:
        trip_job.run(spark, trips, "trip_id", args.out, table)


def estimated(spark: SparkSession, received: DataFrame, args: argparse.Namespace) -> DataFrame:
    """With a zone table, requests without a distance get the estimate. The table is
    settled first: a stream takes no numbered lines."""
    if not args.zones:
        return received
    return distance.estimated_requests(
        received, settle(files.read_zones(spark, args.zones), "zones"))


def predictor(spark: SparkSession, args: argparse.Namespace) -> jobs.Predictor:
    """Of a saved model, or with ``--published`` of the version that counts."""
    if args.published:
        return jobs.published_predictor(spark, args.model)
    forest = model.load(spark, args.model)
    return lambda rows: model.predict(forest, rows)


def score(spark: SparkSession, args: argparse.Namespace) -> None:
    received = estimated(spark, files.read_requests(spark, args.requests), args)
    work = work_folder(spark)
    try:
        checked = settle(requests.check_requests(received), "checked", work)
        scored = predictor(spark, args)(requests.checked_valid(checked, "request_id"))
        named = [c for c in ("model_version",) if c in scored.columns]
        files.write_records(requests.replies(scored, "request_id", *named), f"{args.out}/replies")
        files.write_records(requests.checked_rejects(checked, "request_id"), f"{args.out}/rejected")
    finally:
        remove(spark, work)


def stream_score(spark: SparkSession, args: argparse.Namespace) -> None:
    received = estimated(spark, jobs.request_stream(spark, args.requests), args)
    jobs.stream_answers(received, "request_id", predictor(spark, args), args.out,
                        f"{args.out}/state").awaitTermination()


def stream_ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    run = jobs.stream_corrections if args.corrections else jobs.stream_months
    run(spark, args.source, f"{args.out}/trips", f"{args.out}/state").awaitTermination()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tripline")
    commands = top.add_subparsers(required=True)

    def command(job, name: str, *paths: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.set_defaults(job=job)
        for path in paths:
            sub.add_argument(path)
        return sub

    landing = command(land, "land", "source", "target")
    landing.add_argument("--replace", action="store_true")
    landing.add_argument("--isolate", action="store_true")
    batch = command(run, "run", "trips", "out")
    batch.add_argument("--zones")
    batch.add_argument("--publish", action="store_true")
    command(zones, "zones", "vertices", "names", "out").add_argument("--prj")
    for job, name in ((score, "score"), (stream_score, "stream-score")):
        scoring = command(job, name, "model", "requests", "out")
        scoring.add_argument("--zones")
        scoring.add_argument("--published", action="store_true")
    command(stream_ingest, "stream-ingest", "source", "out").add_argument(
        "--corrections", action="store_true")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.job(pin(SparkSession.builder.appName("tripline").getOrCreate()), args)


if __name__ == "__main__":
    main()
