"""How much of a pixel lies in a zone, as a share of the pixel's square.

In units of the pixel's side, the area of a zone inside a pixel is a sum over the
zone's edges, cut to the pixel's row: what lies east of an edge within the pixel,
plus if the zone begins at the edge, minus if it ends there. An edge wholly west
of a pixel adds its height in the row, whatever the pixel; so those are a running
sum along the row, and only border pixels have a term for each of their edges.
Pixels between border pixels share one weight and stay a run (first, last).

Whether a zone begins or ends at an edge is the even-odd rule at the edge's
middle, looked up in the zone's own grid; two equal edges of a zone cancel. Rings
may touch but not cross.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import edge_list
from .columns import evaluated
from .zonal import cell_key, count_of, grid_entries, gridded

# Pixels of a run are looked up in blocks of two to this power.
BLOCK = 6
# A smaller weight is a rounding error.
LEAST = 1e-9


def _signed_edges(zones: DataFrame, zone_id: str, rings: str) -> DataFrame:
    """Edges (zone, x1, y1, x2, y2, sign) that rise; 1 where the zone begins to the east of it, -1 where it ends."""
    edges = gridded(zones, rings).select(F.col(zone_id).alias("_zone"), "_level", "_c", F.inline(edge_list(rings))).where("y1 < y2")
    edges = edges.groupBy("_zone", "_level", "_c", "x1", "y1", "x2", "y2").agg(F.count("*").alias("n")).where("n % 2 = 1").drop("n")
    middle = edges.selectExpr("*", "(y1 + y2) / 2 AS _y").selectExpr("*", "x1 + (_y - y1) * (x2 - x1) / (y2 - y1) AS _x")
    middle = middle.withColumn("_cell", F.expr(cell_key("_level", "floor(_x / _c)", "floor(_y / _c)")))
    index = grid_entries(zones.select(F.col(zone_id).alias("_zone"), rings), "_zone", rings).selectExpr(
        "_zone", f"{cell_key('_level', 'cx', 'cy')} AS _cell", "odd", "edges"
    )
    # the edge itself counts as west of its middle
    west = f"(if(odd, 1, 0) + aggregate(edges, 0, (a, e) -> a + {count_of('e', '_x', '_y')}))"
    return middle.join(index, ["_zone", "_cell"]).selectExpr("_zone", "x1", "y1", "x2", "y2", f"if({west} % 2 = 1, 1D, -1D) AS sign")


def _east_of(t: str) -> str:
    """SQL: integral, over t, of the share of a unit pixel east of t."""
    inside = f"greatest(0D, least(1D, {t}))"
    return f"(least({t}, 0D) + {inside} - {inside} * {inside} / 2)"


def pixel_weights(
    zones: DataFrame, size: float, origin: tuple[float, float] = (0.0, 0.0), zone_id: str = "zone_id", rings: str = "rings"
) -> DataFrame:
    """(zone, py, first, last, weight): runs of pixels of a row and the share of each that lies in the zone.

    Pixel (px, py) is the square of side ``size`` whose lower left corner is
    ``origin + size * (px, py)``.
    """
    x0, y0, s = (f"{float(v)!r}D" for v in (*origin, size))
    unit = _signed_edges(zones, zone_id, rings).selectExpr(
        "_zone", "sign", f"(x1 - {x0}) / {s} AS x1", f"(y1 - {y0}) / {s} AS y1", f"(x2 - {x0}) / {s} AS x2", f"(y2 - {y0}) / {s} AS y2",
    )
    cut = unit.selectExpr("*", "explode(sequence(floor(y1), floor(y2))) AS py").selectExpr(
        "*", "greatest(y1, py) AS _low", "least(y2, py + 1) AS _high"
    ).where("_low < _high")
    at = "x1 + ({0} - y1) * (x2 - x1) / (y2 - y1)"
    pieces = cut.selectExpr("_zone", "py", "sign * (_high - _low) AS height", f"{at.format('_low')} AS xa", f"{at.format('_high')} AS xb").selectExpr(
        "*", "floor(least(xa, xb)) AS _west", "floor(greatest(xa, xb)) AS _east"
    )
    touched = pieces.repartition("_zone", "py").selectExpr("*", "explode(sequence(_west, _east)) AS px").selectExpr("*", "xa - px AS u", "xb - px AS v")
    share = f"if(abs(u - v) < 1e-12, 1 - greatest(0D, least(1D, u)), ({_east_of('v')} - {_east_of('u')}) / (v - u))"
    border = touched.groupBy("_zone", "py", "px").agg(
        F.expr(f"sum(height * {share}) AS own"), F.expr("sum(if(px = _east, height, 0D)) AS ends"),
    )
    along = Window.partitionBy("_zone", "py").orderBy("px")
    counted = border.select(
        "*", F.coalesce(F.sum("ends").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("west"), F.lead("px").over(along).alias("next"),
    )
    rows = counted.selectExpr("_zone", "py", """inline(array(
        named_struct('first', px, 'last', px, 'weight', west + own),
        named_struct('first', px + 1, 'last', next - 1, 'weight', west + ends)))""")
    kept = rows.where(f"weight > {LEAST} AND first <= last")
    return kept.select(F.col("_zone").alias(zone_id), "py", "first", "last", F.least("weight", F.lit(1.0)).alias("weight"))


def pixels_by_zone(
    pixels: DataFrame, weights: DataFrame, size: float, origin: tuple[float, float] = (0.0, 0.0),
    lon: str = "lon", lat: str = "lat", zone_id: str = "zone_id",
) -> DataFrame:
    """Each pixel with every zone it lies in and its weight there.

    Single pixels are met by their place, runs by the blocks of their row that
    they reach; a pixel asks for both in one equi-join.
    """
    there = f"if(first = last, array({cell_key('0', 'first', 'py')}), transform(sequence(shiftright(first, {BLOCK}), shiftright(last, {BLOCK})), b -> {cell_key('1', 'b', 'py')}))"
    index = weights.selectExpr(f"`{zone_id}`", "py", "first", "last", "weight", f"explode({there}) AS _cell").drop("py")
    px, py = (f"floor((`{c}` - {float(o)!r}D) / {float(size)!r}D)" for c, o in zip((lon, lat), origin, strict=True))
    placed = evaluated(pixels, *dict.fromkeys((lon, lat))).where(f"NOT isnan(`{lon}`) AND NOT isnan(`{lat}`)").selectExpr("*", f"{px} AS _px", f"{py} AS _py")
    keys = f"array({cell_key('0', '_px', '_py')}, {cell_key('1', f'shiftright(_px, {BLOCK})', '_py')})"
    met = placed.selectExpr("*", f"explode({keys}) AS _cell").join(index, "_cell").where("_px BETWEEN first AND last")
    return met.select(*pixels.columns, zone_id, "weight")
