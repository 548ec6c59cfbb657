from __future__ import annotations

import math
import random

import pytest

from tripline.operators.polygons import polygon_centroids, ring_edges, zone_table
from tripline.plans.adapters import SHAPE
from tripline.sources.schemas import RINGS


def frame(spark, rows):
    return spark.createDataFrame(rows, RINGS).repartition(7)


def brute_centroid(rings):
    """Shoelace over whole rings in plain floats."""
    a = mx = my = 0.0
    for ring in rings:
        ox, oy = ring[0]
        for (x, y), (x1, y1) in zip(ring, ring[1:] + ring[:1]):
            u, v, u1, v1 = x - ox, y - oy, x1 - ox, y1 - oy
            c = u * v1 - u1 * v
            a += c
            mx += (u + u1) * c + 3 * ox * c
            my += (v + v1) * c + 3 * oy * c
    return mx / (3 * a), my / (3 * a), abs(a / 2)


def star(n, seed, cx=0.0, cy=0.0):
    rng = random.Random(seed)
    return [(cx + r * math.cos(t), cy + r * math.sin(t))
            for t, r in ((2 * math.pi * i / n, rng.uniform(1, 2)) for i in range(n))]


@pytest.mark.parametrize("block", [2, 3, 4096])
def test_hole_and_second_part(spark, block):
    got = polygon_centroids(frame(spark, [(5, *v) for v in SHAPE]), block).first()
    assert (got.longitude, got.latitude, got.area) == pytest.approx((74.5 / 19, 34.5 / 19, 19.0))


@pytest.mark.parametrize("block", [4, 64, 100_000])
def test_large_and_small_rings_with_gaps(spark, block):
    rng = random.Random(block)
    rings = {1: star(1000, 1, -74.0, 40.7), 2: star(3, 2), 3: star(17, 3, 500.0, 3.0)}
    rows = []
    for zone, ring in rings.items():
        seq = rng.choice([0, 50_000])
        for x, y in ring:
            rows.append((zone, 1, 1, seq, x, y))
            seq += rng.choice([1, 1, 1, 2, 300])
    got = {r.LocationID: r for r in polygon_centroids(frame(spark, rows), block).collect()}
    for zone, ring in rings.items():
        r = got[zone]
        assert (r.longitude, r.latitude, r.area) == pytest.approx(brute_centroid([ring]), rel=1e-9)

    edges = {}
    for r in ring_edges(frame(spark, rows), block).collect():
        edges.setdefault(r.LocationID, []).append((r.seq, r.x, r.y, r.x1, r.y1))
    for zone, ring in rings.items():
        found = [e[1:] for e in sorted(edges[zone])]
        assert found == [(*p, *q) for p, q in zip(ring, ring[1:] + ring[:1])]


def test_closed_and_open_rings_agree(spark):
    ring = star(40, 9, 3.0, 4.0)
    rows = [(1, 1, 1, i, x, y) for i, (x, y) in enumerate(ring)]
    rows += [(2, 1, 1, i, x, y) for i, (x, y) in enumerate([*ring, ring[0]])]
    a, b = polygon_centroids(frame(spark, rows), 8).orderBy("LocationID").collect()
    assert a[1:] == pytest.approx(b[1:])


def test_winding_does_not_matter(spark):
    rows = [(1, 1, 1, i, x, y) for i, (x, y) in enumerate([(0., 0.), (4., 0.), (4., 2.), (0., 2.)])]
    rows += [(2, 1, 1, -r[3], *r[4:]) for r in rows]
    got = polygon_centroids(frame(spark, rows)).collect()
    assert {r[1:] for r in got} == {(2.0, 1.0, 8.0)}


@pytest.mark.parametrize("block", [2, 4096])
def test_roles_not_winding_tell_holes(spark, block):
    """A hole wound like its shell and a part wound the other way."""
    for turned in ((), ((1, 2),), ((2, 1),), ((1, 1),), ((1, 1), (1, 2), (2, 1))):
        rows = [(5, p, r, 4 - s if (p, r) in turned else s, x, y) for p, r, s, x, y in SHAPE]
        got = polygon_centroids(frame(spark, rows), block).first()
        assert (got.longitude, got.latitude, got.area) == pytest.approx(
            (74.5 / 19, 34.5 / 19, 19.0))


def test_sparse_numbers_fold_in_rounds(spark):
    """One vertex a block at first: later rounds bring them together."""
    ring = star(300, 8, -74.0, 40.7)
    rng = random.Random(4)
    seqs = sorted(rng.sample(range(-10**9, 10**9), len(ring)))
    rows = [(1, 1, 1, s, x, y) for s, (x, y) in zip(seqs, ring)]
    got = polygon_centroids(frame(spark, rows), 64).first()
    assert tuple(got)[1:] == pytest.approx(brute_centroid([ring]), rel=1e-9)
    found = [(r.x, r.y, r.x1, r.y1) for r in
             ring_edges(frame(spark, rows), 64).orderBy("seq").collect()]
    assert found == [(*p, *q) for p, q in zip(ring, ring[1:] + ring[:1])]


def test_line_has_no_centroid(spark):
    rows = [(1, 1, 1, i, float(i), 0.0) for i in range(5)]
    got = polygon_centroids(frame(spark, rows), 2).first()
    assert (got.longitude, got.latitude, got.area) == (None, None, 0.0)


def test_small_polygon_far_from_origin_keeps_digits(spark):
    side, x, y = 1e-6, -74.0, 40.7
    square = [(x, y), (x + side, y), (x + side, y + side), (x, y + side)]
    got = polygon_centroids(frame(spark, [(1, 1, 1, i, *p) for i, p in enumerate(square)]), 2).first()
    assert got.longitude == pytest.approx(x + side / 2, abs=1e-12)
    assert got.latitude == pytest.approx(y + side / 2, abs=1e-12)


def test_zone_table_from_projected_polygons(spark):
    rows = [(1, 1, 1, i, 984250.0 + dx, 200000.0 + dy)
            for i, (dx, dy) in enumerate([(-100., -100.), (100., -100.), (100., 100.), (-100., 100.)])]
    names = spark.createDataFrame([(1, "Z", "B")], "LocationID int, zone string, borough string")
    got = zone_table(frame(spark, rows), names).first()
    assert got.longitude == pytest.approx(-74.0, abs=1e-9)
    assert 40.6 < got.latitude < 40.8 and got.zone == "Z"
