"""Footprints against areas: which polygons of two tables share a point; touching counts.

Two closed polygons share a point if an edge of one meets an edge of the other,
or a ring of one lies inside the other; of a ring that meets no edge any corner
tells that. Pairs are found in two equi-joins, never by comparing all with all:

1. Boxes. Every box lies in at most four cells of a grid as coarse as itself, on
   a ladder of grids by powers of four. An area is entered on its own grid and
   all coarser ones, a footprint on its own and the coarser ones of which some
   area has its own; a pair meets on the coarser of its two grids, in the cell
   that holds the lower left corner of what the boxes share, so once.
2. Edges and corners, on the fine grid of the area. Its border cells carry the
   edges that touch them (see :mod:`.zonal`). An edge of the footprint is looked
   up in the cells it touches inside the area's box, and compared with the edges
   there; a corner of the footprint in a cell inside the area needs no test.

Areas are a table: none is a literal of the plan, and nothing runs while the plan
is built. Rows are told apart by their polygon (two hashes of it), on which alone
the answer depends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import bbox, edge_list, parse_rings
from ..functions.geometry import inside, segments_meet
from .columns import computed_once, evaluated
from .zonal import cell_key, count_of, grid_entries, gridded, x_within

# The ladder of box grids: cells of 4 ** FINEST to 4 ** COARSEST.
FINEST, COARSEST = -6, 12
SHAPE = ["_h1", "_h2"]


def area_table(spark: SparkSession, areas: str | dict[str, str]) -> DataFrame:
    """(area_id, rings) of polygon texts; a single one is named ``area``."""
    named = areas if isinstance(areas, dict) else {"area": areas}
    texts = spark.createDataFrame(list(named.items()), "area_id string, wkt string").coalesce(1)
    return texts.select("area_id", parse_rings("wkt").alias("rings"))


def shape_key(rings: str) -> list[Column]:
    return [F.xxhash64(F.col(rings)).alias(SHAPE[0]), F.xxhash64(F.lit(1), F.col(rings)).alias(SHAPE[1])]


def _on_ladder(df: DataFrame, box: str) -> DataFrame:
    """With ``_own``, the level of the grid as coarse as the box."""
    extent = f"greatest({box}.east - {box}.west, {box}.north - {box}.south)"
    return df.withColumn("_own", F.expr(f"cast(least({COARSEST}, greatest({FINEST}, ceil(log(4.0D, {extent})))) AS int)"))


def _box_cells(df: DataFrame, box: str) -> DataFrame:
    """One row for each cell of grid ``_level`` that the box touches."""
    size = "power(4.0D, _level)"
    across = df.selectExpr("*", f"explode(sequence(floor({box}.west / {size}), floor({box}.east / {size}))) AS _cx")
    return across.selectExpr("*", f"explode(sequence(floor({box}.south / {size}), floor({box}.north / {size}))) AS _cy")


def _box_pairs(shapes: DataFrame, areas: DataFrame) -> DataFrame:
    """Shapes (_box) and areas (_area_box) whose boxes share a point, each pair once."""
    levels = areas.agg(F.collect_set("_own")).scalar()
    there = _box_cells(
        shapes.withColumn("_levels", levels).selectExpr("*", "explode(array_distinct(array_append(filter(_levels, l -> l > _own), _own))) AS _level"), "_box"
    ).withColumnRenamed("_own", "_shape_own").drop("_levels")
    here = _box_cells(areas.selectExpr("*", f"explode(sequence(_own, {COARSEST})) AS _level"), "_area_box")
    size = "power(4.0D, _level)"
    return there.join(here, ["_level", "_cx", "_cy"]).where(
        "_level = greatest(_shape_own, _own) AND _box.west <= _area_box.east AND _area_box.west <= _box.east"
        " AND _box.south <= _area_box.north AND _area_box.south <= _box.north"
        f" AND _cx = floor(greatest(_box.west, _area_box.west) / {size}) AND _cy = floor(greatest(_box.south, _area_box.south) / {size})"
    ).drop("_level", "_cx", "_cy", "_own", "_shape_own")


def _probes(pairs: DataFrame) -> DataFrame:
    """What of a footprint is looked up in its area: (kind, x1, y1, x2, y2, _cell).

    Kind 0: decided, a ring of the area lies inside the footprint. 1: the first
    corner of a ring. 2: an edge, once for each cell of the area that it touches.
    """
    around = f"exists(_area_heads, p -> p.x BETWEEN _box.west AND _box.east AND p.y BETWEEN _box.south AND _box.north AND {inside('_edges', 'p.x', 'p.y')})"
    looked_up = computed_once(pairs, _edges=edge_list("_rings")).selectExpr(
        *SHAPE, "_area", "_area_box", "_level", "_c",
        f"""inline(if({around}, array(named_struct('kind', 0, 'x1', 0D, 'y1', 0D, 'x2', 0D, 'y2', 0D)), concat(
            transform(_rings, r -> named_struct('kind', 1, 'x1', r[0].x, 'y1', r[0].y, 'x2', r[0].x, 'y2', r[0].y)),
            transform(_edges, e -> named_struct('kind', 2, 'x1', e.x1, 'y1', e.y1, 'x2', e.x2, 'y2', e.y2)))))""",
    )
    # an edge that touches a cell's border belongs to both cells, whatever the rounding
    more = "if(kind = 2, _c * 1e-9D, 0D)"
    in_rows = looked_up.selectExpr(
        "*", f"greatest(floor((y1 - {more}) / _c), floor(_area_box.south / _c)) AS _first", f"least(floor((y2 + {more}) / _c), floor(_area_box.north / _c)) AS _last",
    ).selectExpr("*", "explode(CASE WHEN kind = 0 THEN array(0L) WHEN _first <= _last THEN sequence(_first, _last) END) AS cy")
    low, high = x_within("floor(y1 / _c)", "floor(y2 / _c)")
    in_cells = in_rows.selectExpr(
        "*", f"greatest(floor(({low} - {more}) / _c), floor(_area_box.west / _c)) AS _west", f"least(floor(({high} + {more}) / _c), floor(_area_box.east / _c)) AS _east",
    ).selectExpr("*", "explode(CASE WHEN kind = 0 THEN array(0L) WHEN _west <= _east THEN sequence(_west, _east) END) AS cx")
    return in_cells.selectExpr(*SHAPE, "_area", "kind", "x1", "y1", "x2", "y2", f"if(kind = 0, null, {cell_key('_level', 'cx', 'cy')}) AS _cell")


def _near(df: DataFrame, rings: str, areas: DataFrame, area_rings: str) -> DataFrame:
    """Rows whose box (kept as ``_box``) meets the box around all areas, which is found when the query runs."""
    boxes = areas.select(bbox(area_rings).alias("b"))
    around = boxes.agg(F.struct(
        F.min("b.west").alias("west"), F.max("b.east").alias("east"), F.min("b.south").alias("south"), F.max("b.north").alias("north")
    )).scalar()
    boxed = computed_once(evaluated(df, rings), _box=bbox(rings)).withColumn("_around", around)
    return boxed.where(
        "_box.west <= _around.east AND _around.west <= _box.east AND _box.south <= _around.north AND _around.south <= _box.north"
    ).drop("_around")


def shapes_in_areas(df: DataFrame, areas: DataFrame, rings: str = "rings", area_id: str = "area_id", area_rings: str = "rings") -> DataFrame:
    """(_h1, _h2, area_id) for every polygon of ``df`` and area that share a point; one row per area in ``areas``."""
    shapes = _near(df.select(F.col(rings).alias("_rings")), "_rings", areas, area_rings).select(*shape_key("_rings"), "_rings", "_box")
    named = areas.select(F.col(area_id).alias("_area"), F.col(area_rings).alias("_area_rings"))
    grid = gridded(named, "_area_rings").select(
        "_area", F.col("_box").alias("_area_box"), "_level", "_c", F.expr("transform(_area_rings, r -> r[0])").alias("_area_heads"),
    ).where("_area_box.west IS NOT NULL")
    pairs = _box_pairs(_on_ladder(shapes, "_box"), _on_ladder(grid.withColumnRenamed("_level", "_grid"), "_area_box")).withColumnRenamed("_grid", "_level")
    index = grid_entries(named, "_area", "_area_rings").selectExpr(
        "_area", f"{cell_key('_level', 'cx', 'cy')} AS _cell", "odd", "edges",
    )
    corner_in = f"(if(odd, 1, 0) + aggregate(edges, 0, (a, e) -> a + {count_of('e', 'x1', 'y1')})) % 2 = 1"
    edge_meets = f"exists(edges, e -> {segments_meet('e', '_probe')})"
    met = _probes(pairs).withColumn("_probe", F.struct("x1", "y1", "x2", "y2")).join(index, ["_area", "_cell"], "left").where(
        f"kind = 0 OR (kind = 1 AND {corner_in}) OR (kind = 2 AND {edge_meets})"
    )
    return met.select(*SHAPE, F.col("_area").alias(area_id)).distinct()


def _areas_of(df: DataFrame, area: str | DataFrame) -> DataFrame:
    return area if isinstance(area, DataFrame) else area_table(df.sparkSession, area)


def intersects_aoi(df: DataFrame, rings: str, area: str | DataFrame, area_id: str = "area_id", area_rings: str = "rings") -> DataFrame:
    """Rows whose polygon shares a point with an area: one as text, or any number as a table."""
    areas = _areas_of(df, area)
    found = shapes_in_areas(df, areas, rings, area_id, area_rings).select(*SHAPE).distinct()
    return _near(df, rings, areas, area_rings).select("*", *shape_key(rings)).join(found, SHAPE, "left_semi").select(*df.columns)


def with_areas(df: DataFrame, rings: str, areas: DataFrame, area_id: str = "area_id", area_rings: str = "rings") -> DataFrame:
    """Every row once for each area that its polygon meets, with the area's id."""
    found = shapes_in_areas(df, areas, rings, area_id, area_rings)
    return _near(df, rings, areas, area_rings).select("*", *shape_key(rings)).join(found, SHAPE).select(*df.columns, area_id)
