"""Footprints against areas, by comparing all with all."""

import math
import random

from pyspark.sql import functions as F

from themelake.functions import parse_rings
from themelake.operators import area_table, intersects_aoi, with_areas

SHAPES = "name string, rings array<array<struct<x:double,y:double>>>"


def edges(rings):
    return [(p, q) for r in rings for p, q in zip(r, r[1:] + r[:1])]


def side(p, q, r):
    return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])


def meet(e, f):
    (a, b), (c, d) = e, f
    if max(a[0], b[0]) < min(c[0], d[0]) or max(c[0], d[0]) < min(a[0], b[0]) or max(a[1], b[1]) < min(c[1], d[1]) or max(c[1], d[1]) < min(a[1], b[1]):
        return False
    return side(a, b, c) * side(a, b, d) <= 0 and side(c, d, a) * side(c, d, b) <= 0


def within(p, rings):
    return sum(
        1 for (a, b) in edges(rings)
        if min(a[1], b[1]) <= p[1] < max(a[1], b[1]) and p[0] < a[0] + (p[1] - a[1]) * (b[0] - a[0]) / (b[1] - a[1])
    ) % 2 == 1


def share(a, b):
    return (
        any(meet(e, f) for e in edges(a) for f in edges(b)) or any(within(r[0], b) for r in a) or any(within(r[0], a) for r in b)
    )


def star(rng, x, y, size, n):
    angles = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
    return [(x + size * rng.uniform(0.4, 1) * math.cos(a), y + size * rng.uniform(0.4, 1) * math.sin(a)) for a in angles]


def table(spark, shapes):
    return spark.createDataFrame([(n, [[(float(x), float(y)) for x, y in r] for r in rings]) for n, rings in shapes], SHAPES)


def test_random_polygons_of_all_sizes(spark):
    rng = random.Random(11)
    shapes = [(f"s{i}", [star(rng, rng.uniform(-9, 9), rng.uniform(-9, 9), 10 ** rng.uniform(-2, 1), rng.randint(3, 9))]) for i in range(120)]
    areas = [(f"a{i}", [star(rng, rng.uniform(-9, 9), rng.uniform(-9, 9), 10 ** rng.uniform(-2, 1), rng.choice([3, 7, 60]))]) for i in range(25)]
    ring = lambda s: [(-s, -s), (s, -s), (s, s), (-s, s)]
    areas += [("frame", [ring(8), ring(5)]), ("parts", [star(rng, -6, 6, 1, 5), star(rng, 6, -6, 1, 5)])]
    shapes += [("in the hole", [ring(1)]), ("around the hole", [ring(5.5), ring(4.5)]), ("on the border", [[(5, 0), (4, 1), (4, -1)]]), ("closed", [[*ring(2), ring(2)[0]]])]
    found = with_areas(table(spark, shapes), "rings", table(spark, areas).withColumnRenamed("name", "area_id"))
    expected = sorted((s, a) for s, x in shapes for a, y in areas if share(x, y))
    assert sorted((r.name, r.area_id) for r in found.collect()) == expected and len(expected) > 100


def test_a_concave_area_of_five_thousand_corners(spark, plan):
    n = 5000
    comb = [(i / 100, (0.0 if i % 2 else 40.0 + math.sin(i))) for i in range(n)] + [(50.0, -1.0), (0.0, -1.0)]
    areas = table(spark, [("comb", [comb])]).withColumnRenamed("name", "area_id")
    rng = random.Random(5)
    shapes = [(f"s{i}", [star(rng, rng.uniform(-2, 52), rng.uniform(-3, 43), 0.02, 4)]) for i in range(150)]
    jobs = spark.sparkContext.statusTracker()
    before = len(jobs.getJobIdsForGroup())
    found = intersects_aoi(table(spark, shapes), "rings", areas)
    assert len(jobs.getJobIdsForGroup()) == before  # nothing runs while the plan is built
    expected = sorted(s for s, x in shapes if share(x, [comb]))
    assert sorted(r.name for r in found.collect()) == expected and 30 < len(expected) < 140
    text = plan(found)
    assert "NestedLoop" not in text and "Cartesian" not in text and "Python" not in text and "49.99" not in text


def test_areas_as_texts_and_rows_kept_whole(spark):
    areas = area_table(spark, {"west": "POLYGON((0 0, 1 0, 1 1, 0 1, 0 0))", "east": "POLYGON((1 0, 2 0, 2 1, 1 1, 1 0))"})
    df = spark.createDataFrame([
        (1, "POLYGON((0.2 0.2, 0.4 0.2, 0.4 0.4, 0.2 0.2))"), (2, "POLYGON((1 0.2, 1.4 0.2, 1.4 0.4, 1 0.2))"),
        (2, "POLYGON((1 0.2, 1.4 0.2, 1.4 0.4, 1 0.2))"), (3, "POLYGON((5 5, 6 5, 6 6, 5 5))"), (4, None),
    ], "area int, wkt string").withColumn("shape", parse_rings("wkt"))
    both = with_areas(df, "shape", areas)
    assert both.columns == [*df.columns, "area_id"]
    assert sorted((r.area, r.area_id) for r in both.collect()) == [(1, "west"), (2, "east"), (2, "east"), (2, "west"), (2, "west")]
    assert sorted(r.area for r in intersects_aoi(df, "shape", areas).collect()) == [1, 2, 2]
    assert intersects_aoi(df, "shape", areas.limit(0)).count() == 0
    assert intersects_aoi(df.where("area = 4"), "shape", areas).count() == 0


def test_one_area_met_by_most_rows(spark):
    df = spark.range(3000).select("id", F.array(F.array(*[
        F.struct((F.col("id") % 3 * 10 + x).cast("double").alias("x"), F.lit(y).alias("y")) for x, y in ((0.0, 0.0), (1.0, 0.0), (0.0, 1.0))
    ])).alias("rings"))
    areas = area_table(spark, {"hot": "POLYGON((-1 -1, 2 -1, 2 2, -1 2))", "none": "POLYGON((50 50, 51 50, 51 51))"})
    assert [tuple(r) for r in with_areas(df, "rings", areas).groupBy("area_id").count().collect()] == [("hot", 1000)]
