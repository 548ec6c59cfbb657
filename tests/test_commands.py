"""The command line, from monthly files to replies."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tripline.__main__ import main
from tripline.plans import adapters
from tripline.sources.files import read_zones, write_zones


def lines(folder):
    return [json.loads(line) for f in sorted(folder.glob("part-*"))
            for line in f.read_text().splitlines()]


def test_from_months_to_replies(spark, sf_dir, tmp_path, capsys):
    trips = adapters.trips_from_orders(adapters.table(spark, sf_dir, "orders"))
    source, landed, out = (str(tmp_path / n) for n in ("source", "landed", "out"))
    for year in (1996, 1997):
        (trips.filter(F.year("tpep_pickup_datetime") == year).coalesce(1)
         .write.parquet(f"{source}/trips_{year}-01.parquet"))
    main(["land", source, landed])
    main(["land", source, landed, "--isolate"])
    assert capsys.readouterr().out.split() == ["1996-01", "landed", "1997-01", "landed"]

    write_zones(adapters.zones(spark), str(tmp_path / "zones"))
    main(["run", landed, out, "--zones", str(tmp_path / "zones")])
    hot = lines(tmp_path / "out" / "hotspots")
    assert hot and hot == sorted(hot, key=lambda r: (-r["trip_count"], r["LocationID"]))

    asked = tmp_path / "asked"
    asked.mkdir()
    good = {"request_id": "a", "trip_distance": 5.0, "PULocationID": 237, "DOLocationID": 236,
            "pickup_hour": 17, "pickup_dow": 3}
    bad = {**good, "request_id": "b", "pickup_hour": "late"}
    (asked / "1.json").write_text(json.dumps(good) + "\n" + json.dumps(bad) + "\n")

    rings = adapters.projected_rings_from_customers(adapters.table(spark, sf_dir, "customer"))
    rings.write.parquet(str(tmp_path / "rings"))
    adapters.zone_names_from_customers(adapters.table(spark, sf_dir, "customer")).write.parquet(
        str(tmp_path / "names"))
    main(["zones", str(tmp_path / "rings"), str(tmp_path / "names"), str(tmp_path / "table")])
    table = {r.LocationID: r for r in read_zones(spark, str(tmp_path / "table")).collect()}
    assert 40 < table[1].latitude < 41 and table[1].zone == "Zone_1"

    estimate = tmp_path / "estimate"
    estimate.mkdir()
    (estimate / "1.json").write_text("".join(json.dumps(
        {**good, "request_id": i, "trip_distance": None, "PULocationID": 1, "DOLocationID": do})
        + "\n" for i, do in (("c", 2), ("d", 10**6))))
    main(["score", f"{out}/model", str(estimate), str(tmp_path / "est"), "--zones",
          str(tmp_path / "table")])
    main(["stream-score", f"{out}/model", str(estimate), str(tmp_path / "est-stream"), "--zones",
          str(tmp_path / "table")])
    reply, = lines(tmp_path / "est" / "replies")
    streamed, = spark.read.parquet(str(tmp_path / "est-stream" / "replies")).collect()
    assert reply["inputs"]["trip_distance"] > 0
    assert streamed.inputs.trip_distance == reply["inputs"]["trip_distance"]
    rejected, = lines(tmp_path / "est" / "rejected")
    assert (rejected["request_id"], rejected["first_invalid"]) == ("d", "DOLocationID unknown")

    main(["score", f"{out}/model", str(asked), str(tmp_path / "scored")])
    reply, = lines(tmp_path / "scored" / "replies")
    rejected, = lines(tmp_path / "scored" / "rejected")
    assert reply["request_id"] == "a" and reply["predicted_duration_mins"] > 0
    assert reply["inputs"] == {k: v for k, v in good.items() if k != "request_id"}
    assert (rejected["request_id"], rejected["first_invalid"]) == ("b", "pickup_hour")

    for _ in range(2):
        main(["stream-score", f"{out}/model", str(asked), str(tmp_path / "streamed")])
    streamed = spark.read.parquet(str(tmp_path / "streamed" / "replies")).collect()
    assert [(r.request_id, r.predicted_duration_mins) for r in streamed] == [
        ("a", reply["predicted_duration_mins"])]
    assert spark.read.parquet(str(tmp_path / "streamed" / "rejected")).count() == 1

    main(["stream-ingest", source, str(tmp_path / "ingested")])
    assert spark.read.parquet(str(tmp_path / "ingested" / "trips")).count() > 0


def test_published_models_projections_and_corrections(spark, sf_dir, tmp_path, capsys):
    trips = adapters.trips_from_orders(adapters.table(spark, sf_dir, "orders"))
    source, landed, out = (str(tmp_path / n) for n in ("source", "landed", "out"))
    (trips.filter(F.year("tpep_pickup_datetime") == 1996).coalesce(1)
     .write.parquet(f"{source}/d1/trips_1996-01.parquet"))
    main(["land", f"{source}/d1", landed])
    for _ in range(2):
        main(["run", landed, out, "--publish"])
    assert capsys.readouterr().out.split()[-2:] == ["1", "2"]
    asked = tmp_path / "asked"
    asked.mkdir()
    (asked / "1.json").write_text(json.dumps(
        {"request_id": "a", "trip_distance": 5.0, "PULocationID": 237, "DOLocationID": 236,
         "pickup_hour": 17, "pickup_dow": 3}) + "\nno request\n")
    main(["score", out, str(asked), str(tmp_path / "scored"), "--published"])
    reply, = lines(tmp_path / "scored" / "replies")
    rejected, = lines(tmp_path / "scored" / "rejected")
    assert reply["model_version"] == 2 and rejected["malformed"] == "no request"
    for _ in range(2):
        main(["stream-score", out, str(asked), str(tmp_path / "streamed"), "--published"])
    streamed, = spark.read.parquet(str(tmp_path / "streamed" / "replies")).collect()
    assert (streamed.model_version, streamed.predicted_duration_mins) == (
        2, reply["predicted_duration_mins"])

    prj = tmp_path / "zones.prj"
    prj.write_text(adapters.PROJECTIONS["two"])
    customers = adapters.table(spark, sf_dir, "customer")
    adapters.projected_rings_from_customers(customers).write.parquet(str(tmp_path / "rings"))
    adapters.zone_names_from_customers(customers).write.parquet(str(tmp_path / "names"))
    for name, more in (("plain", []), ("by-prj", ["--prj", str(prj)])):
        main(["zones", str(tmp_path / "rings"), str(tmp_path / "names"), str(tmp_path / name), *more])
    assert sorted(read_zones(spark, str(tmp_path / "plain")).collect()) == sorted(
        read_zones(spark, str(tmp_path / "by-prj")).collect())

    main(["stream-ingest", source, str(tmp_path / "months"), "--corrections"])
    assert {r.delivery for r in spark.read.parquet(str(tmp_path / "months" / "trips")).collect()} == {"d1"}


def test_failed_months_end_in_an_error(tmp_path, spark):
    source = tmp_path / "source"
    source.mkdir()
    (source / "trips_2023-01.parquet").write_bytes(b"no parquet")
    with pytest.raises(SystemExit, match="some months failed"):
        main(["land", str(source), str(tmp_path / "landed"), "--isolate"])
