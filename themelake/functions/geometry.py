"""Polygons as ``array<array<struct<x,y>>>``: a list of rings.

Holes and further parts are just more rings under one even-odd rule. The rule
is half-open, so a point on a border shared by two polygons is in exactly one.
Every edge is written from its lower end to its upper end; two polygons that
share an edge then compute the same crossing for it, bit by bit.

The expressions are written as SQL over column names: one text is parsed where
dozens of nested calls would each go to the JVM and back.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .text import _col

RINGS_TYPE = "array<array<struct<x:double,y:double>>>"


def parse_rings(wkt: Column | str) -> Column:
    """Rings of a ``POLYGON``/``MULTIPOLYGON`` text; invalid text fails the job."""
    text = _col(wkt)

    def vertex(pair: Column) -> Column:
        xy = F.regexp_extract_all(pair, F.lit(r"[^\s]+"), F.lit(0))
        return F.struct(
            xy[0].cast("double").alias("x"),
            xy[1].cast("double").alias("y"),
        )

    rings = F.transform(
        F.regexp_extract_all(text, F.lit(r"\(([^()]+)\)"), F.lit(1)),
        lambda ring: F.transform(F.split(ring, ","), vertex),
    )
    valid = text.rlike(r"(?is)^\s*(MULTI)?POLYGON\s*\(\s*\(.*\)\s*\)\s*$")
    return F.when(valid, rings).when(
        text.isNotNull(), F.raise_error(F.concat(F.lit("invalid polygon: "), text)).cast(RINGS_TYPE)
    )


def geojson_rings(geometry: str) -> Column:
    """Rings of a GeoJSON polygon or multipolygon; other kinds have none.

    ``geometry`` has ``type`` and, as text, ``coordinates``: they nest one level
    deeper in a multipolygon, so no single array type holds both.
    """
    text, kind = f"{geometry}.coordinates", f"{geometry}.type"
    rings = (
        f"CASE {kind} WHEN 'MultiPolygon' THEN flatten(from_json({text}, 'array<array<array<array<double>>>>'))"
        f" WHEN 'Polygon' THEN from_json({text}, 'array<array<array<double>>>') END"
    )
    return F.expr(f"transform({rings}, ring -> transform(ring, p -> named_struct('x', p[0], 'y', p[1])))")


def geojson_text(geometry: str) -> Column:
    """A geometry with its coordinates as text, as one JSON text."""
    kind = F.to_json(F.expr(f"struct({geometry}.type)"))
    return F.concat(F.rtrim(kind, F.lit("}")), F.lit(',"coordinates":'), F.regexp_replace(f"{geometry}.coordinates", r"\s", ""), F.lit("}"))


def bbox(rings: str) -> Column:
    """(south, west, north, east) of a rings column."""
    xs, ys = f"flatten({rings}).x", f"flatten({rings}).y"
    return F.expr(
        f"named_struct('south', array_min({ys}), 'west', array_min({xs}),"
        f" 'north', array_max({ys}), 'east', array_max({xs}))"
    )


def edge_list(rings: str) -> Column:
    """All edges of a rings column, lower end first; an open ring is closed."""
    ends = "concat(slice(ring, 2, size(ring)), slice(ring, 1, 1))"
    upward = "named_struct('x1', p.x, 'y1', p.y, 'x2', q.x, 'y2', q.y)"
    downward = "named_struct('x1', q.x, 'y1', q.y, 'x2', p.x, 'y2', p.y)"
    edge = f"(p, q) -> if(p.y <= q.y, {upward}, {downward})"
    return F.expr(f"flatten(transform({rings}, ring -> zip_with(ring, {ends}, {edge})))")


def crosses(edge: str, x: str, y: str) -> str:
    """SQL: does the ray from (x, y) towards larger x cross this edge?"""
    at_y = f"{edge}.x1 + ({y} - {edge}.y1) * ({edge}.x2 - {edge}.x1) / ({edge}.y2 - {edge}.y1)"
    return f"({edge}.y1 <= {y} AND {y} < {edge}.y2 AND {x} < {at_y})"


def inside(edges: str, x: str, y: str) -> str:
    """SQL: point in polygon by the even-odd rule."""
    return f"(size(filter({edges}, e -> {crosses('e', x, y)})) % 2 = 1)"


def even_odd(edges: str, x: str, y: str) -> Column:
    """Point in polygon by the even-odd rule, over an edges column."""
    return F.expr(inside(edges, x, y))


def segments_meet(e: str, f: str) -> str:
    """SQL: closed segments share a point; touching counts."""

    def side(s: str, px: str, py: str) -> str:
        return f"signum(({s}.x2 - {s}.x1) * ({py} - {s}.y1) - ({s}.y2 - {s}.y1) * ({px} - {s}.x1))"

    def splits(s: str, t: str) -> str:
        return f"{side(s, f'{t}.x1', f'{t}.y1')} * {side(s, f'{t}.x2', f'{t}.y2')} <= 0"

    return (
        f"(least({e}.x1, {e}.x2) <= greatest({f}.x1, {f}.x2) AND least({f}.x1, {f}.x2) <= greatest({e}.x1, {e}.x2)"
        f" AND {e}.y1 <= {f}.y2 AND {f}.y1 <= {e}.y2 AND {splits(e, f)} AND {splits(f, e)})"
    )


def rings_of(spark: SparkSession, wkt: str) -> list[list[tuple[float, float]]]:
    """Rings of one polygon text, read once instead of for every row."""
    rings = spark.range(1).select(parse_rings(F.lit(wkt)).alias("rings")).first()["rings"]
    return [[(p["x"], p["y"]) for p in ring] for ring in rings]


def box_of(rings: list[list[tuple[float, float]]]) -> tuple[float, float, float, float]:
    """(south, west, north, east)."""
    xs = [x for ring in rings for x, _ in ring]
    ys = [y for ring in rings for _, y in ring]
    return min(ys), min(xs), max(ys), max(xs)
