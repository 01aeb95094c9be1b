"""Shares of pixels in zones."""

import math
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from themelake.operators import pixel_weights, pixels_by_zone, zonal_stats

ZONES = "zone_id string, rings array<array<struct<x:double,y:double>>>"


def zones_of(spark, zones):
    return spark.createDataFrame([(z, [[(float(x), float(y)) for x, y in r] for r in rings]) for z, rings in zones], ZONES)


def clipped_area(ring, x0, y0, s):
    """Area of a convex polygon inside a square, by cutting it with four half planes."""
    points = list(ring)
    for axis, bound, keep_less in ((0, x0, False), (0, x0 + s, True), (1, y0, False), (1, y0 + s, True)):
        out = []
        for p, q in zip(points, points[1:] + points[:1]):
            inside = [(v[axis] <= bound) if keep_less else (v[axis] >= bound) for v in (p, q)]
            if inside[0]:
                out.append(p)
            if inside[0] != inside[1]:
                t = (bound - p[axis]) / (q[axis] - p[axis])
                out.append(tuple(a + t * (b - a) for a, b in zip(p, q)))
        points = out
        if not points:
            return 0.0
    return abs(sum(p[0] * q[1] - p[1] * q[0] for p, q in zip(points, points[1:] + points[:1]))) / 2


def by_pixel(df):
    out = {}
    for r in df.collect():
        for px in range(r["first"], r["last"] + 1):
            assert (r.zone_id, px, r.py) not in out
            out[r.zone_id, px, r.py] = r.weight
    return out


def convex(rng, x, y, size):
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(rng.randint(3, 9)))
    return [(x + size * math.cos(a), y + size * math.sin(a)) for a in angles]


@pytest.mark.parametrize("size, origin", [(0.37, (0.0, 0.0)), (1.0, (0.11, -0.3)), (5.0, (-2.0, -2.0))])
def test_weights_against_cut_polygons(spark, size, origin):
    rng = random.Random(2)
    shapes = [(f"z{i}", convex(rng, rng.uniform(-4, 4), rng.uniform(-4, 4), rng.uniform(0.05, 3))) for i in range(15)]
    found = by_pixel(pixel_weights(zones_of(spark, [(z, [r]) for z, r in shapes]), size, origin))
    expected = {}
    for z, ring in shapes:
        for px in range(math.floor((-8 - origin[0]) / size), math.ceil((8 - origin[0]) / size)):
            for py in range(math.floor((-8 - origin[1]) / size), math.ceil((8 - origin[1]) / size)):
                w = clipped_area(ring, origin[0] + px * size, origin[1] + py * size, size) / size**2
                if w > 1e-9:
                    expected[z, px, py] = w
    assert set(found) == set(expected) and all(abs(found[k] - expected[k]) < 1e-9 for k in found)


def test_weights_of_a_pixel_over_neighbours_sum_to_one(spark):
    """A square cut into cells of a bent grid: every pixel inside is shared out whole."""
    rng, n = random.Random(4), 6
    corner = [[(x + (rng.uniform(-0.3, 0.3) if 0 < x < n else 0), y + (rng.uniform(-0.3, 0.3) if 0 < y < n else 0)) for y in range(n + 1)] for x in range(n + 1)]
    zones = [(f"{x}.{y}", [[corner[x][y], corner[x + 1][y], corner[x + 1][y + 1], corner[x][y + 1]]]) for x in range(n) for y in range(n)]
    total = {}
    for (_, px, py), w in by_pixel(pixel_weights(zones_of(spark, zones), 0.25)).items():
        total[px, py] = total.get((px, py), 0) + w
    assert len(total) == 24 * 24 and all(abs(w - 1) < 1e-9 for w in total.values())


def test_holes_parts_sharing_a_side_and_any_direction(spark):
    box = lambda x, y, s: [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]
    zones = [
        ("hole", [box(0, 0, 4), box(1.5, 1.5, 1)]), ("hole, turned", [box(0, 0, 4)[::-1], box(1.5, 1.5, 1)]),
        ("two halves", [[(0, 0), (4, 0), (4, 4)], [(0, 0), (4, 4), (0, 4)]]), ("long", [[(-50, 0.25), (50, 0.25), (50, 0.75), (-50, 0.75)]]),
        ("island in the hole", [box(0, 0, 8), box(1, 1, 6), box(3.5, 3.5, 1)]),
    ]
    found = by_pixel(pixel_weights(zones_of(spark, zones), 1.0))
    area = {z: sum(w for (n, _, _), w in found.items() if n == z) for z, _ in zones}
    assert {z: round(a, 9) for z, a in area.items()} == {"hole": 15, "hole, turned": 15, "two halves": 16, "long": 50, "island in the hole": 29}
    assert found["hole", 1, 1] == 0.75 and found["long", 7, 0] == 0.5 and found["two halves", 2, 2] == 1


def test_weighted_statistics(spark):
    zones = zones_of(spark, [("a", [[(0, 0), (1.5, 0), (1.5, 1), (0, 1)]]), ("b", [[(1.5, 0), (4, 0), (4, 1), (1.5, 1)]]), ("far", [[(9, 9), (10, 9), (9, 10)]])])
    pixels = spark.createDataFrame(
        [(0.5, 0.5, date(2018, 1, 1), 2.0), (1.5, 0.5, date(2018, 1, 2), 8.0), (2.5, 0.5, date(2018, 1, 3), 5.0), (1.4, 0.2, date(2018, 2, 1), float("nan")),
         (float("nan"), 0.5, date(2018, 1, 1), 1.0), (None, 0.5, date(2018, 1, 1), 1.0)], "lon double, lat double, date date, avg_rad double")
    got = {r.zone_id: r for r in zonal_stats(pixels, zones, pixel_size=1.0).collect()}
    assert set(got) == {"a", "b"} and got["a"].date == "2018-01"
    assert got["a"].mean == pytest.approx((2 + 8 * 0.5) / 1.5) and got["b"].mean == pytest.approx((5 + 8 * 0.5) / 1.5)
    assert (got["a"].min, got["a"].max) == (2, 8) and got["a"].stdDev == pytest.approx(math.sqrt((4 + 32) / 1.5 - 16))
    with pytest.raises(ValueError, match="population"):
        zonal_stats(pixels, zones, pixel_size=1.0, sample=True)
    assert zonal_stats(pixels, zones.limit(0), pixel_size=1.0).count() == 0


def test_long_runs_meet_their_pixels(spark, plan):
    zones = zones_of(spark, [("wide", [[(-300, 0), (300, 0), (300, 2), (-300, 2)]])])
    pixels = spark.range(-400, 400).select((F.col("id") + 0.5).alias("lon"), F.lit(1.5).alias("lat"), "id")
    weights = pixel_weights(zones, 1.0)
    found = pixels_by_zone(pixels, weights, 1.0)
    assert sorted(r.id for r in found.collect()) == list(range(-300, 300)) and found.where("weight <> 1").count() == 0
    assert weights.count() < 10 and "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)
