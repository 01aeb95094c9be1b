"""Points in polygons and zonal statistics.

Every zone is cut along a grid of its own size, by powers of four, fitting its
extent and its number of edges; zones of all sizes then have an index that is
linear in their edges. An edge goes to the cells that it touches. Whether a cell
lies inside is a running count along its row of the grid: of the edges that cross
the row's lower border, how many end west of the cell. Runs of cells between
border cells are all inside or all outside. A border cell carries its own edges
only, never those of its row.

Points find their zones by an equi-join on (grid size, cell), a point once for
every grid size there is; never by comparing all with all.

The result is that of the even-odd rule over all edges, bit by bit. Let a point
be in cell (cx, cy). An edge wholly west of the cell, in its row, counts if it
spans the point's y. Written by ends, that is one constant for an edge that comes
from below the row, and a step at the y of every end inside the row. The steps of
two neighbouring edges at their common end cancel, unless one of them touches the
cell; so steps are kept with the cell's own edges (``t1``, ``t2``), and only the
constants are counted along the row. All comparisons are between floors of
coordinates or coordinates themselves. Rings must be closed or are closed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import bbox, edge_list, month_label
from .columns import computed_once, evaluated

# A grid index up to this size goes to every executor, a larger one is shuffled.
BROADCAST_BYTES = 64 * 1024 * 1024
_EDGE_BYTES = 72
_CELL_BYTES = 320
# Edges of a border cell that get columns of their own.
FLAT_EDGES = 4
# Cells across a zone of few edges; one of many has the square root of their number.
CELLS_ACROSS = 6
# Columns and rows have 28 bits each in a cell's key.
_REACH = 2**27


def cell_key(level: str, cx: str, cy: str) -> str:
    """SQL: grid size, column and row in one number, so that the join key is a single long."""
    mask = 2 * _REACH - 1
    return f"(shiftleft(cast({level} + 32 AS bigint), 56) | shiftleft(({cx}) & {mask}L, 28) | (({cy}) & {mask}L))"


def point_key(level: str, size: str, x: str, y: str) -> str:
    """SQL: key of the cell a point is in; null if no zone can be there."""
    near = f"abs({x}) < {size} * {_REACH} AND abs({y}) < {size} * {_REACH}"
    return f"if({near}, {cell_key(level, f'floor({x} / {size})', f'floor({y} / {size})')}, null)"


@dataclass(frozen=True)
class ZoneSummary:
    """What one pass over the zones says: the grid sizes in use, by level, and a bound for the index's bytes."""

    sizes: dict[int, float]
    index_bytes: float


def gridded(zones: DataFrame, rings: str, cell: float | None = None, across: int = CELLS_ACROSS) -> DataFrame:
    """``zones`` with ``_level`` and ``_c``, the cell size of their grid: a power of four, or ``cell`` for all."""
    boxed = computed_once(evaluated(zones, rings), _box=bbox(rings), _n=F.expr(f"size(flatten({rings}))"))
    if cell is not None:
        return boxed.withColumns({"_level": F.lit(0), "_c": F.lit(float(cell))})
    extent = "greatest(_box.east - _box.west, _box.north - _box.south)"
    reach = "greatest(abs(_box.east), abs(_box.west), abs(_box.north), abs(_box.south))"
    fitting = f"round(log(4.0D, {extent} / greatest({across}.0D, sqrt(_n))))"
    # fine enough for the zone, yet with few enough columns for the key
    level = F.expr(f"cast(coalesce(greatest({fitting}, ceil(log(4.0D, {reach} / {_REACH // 2}.0D)), -31), 0) AS int)")
    return computed_once(boxed, _level=level).withColumn("_c", F.expr("power(4.0D, _level)"))


def summarise_zones(zones: DataFrame, zone_id: str = "zone_id", rings: str = "rings", cell: float | None = None) -> ZoneSummary:
    """Grid sizes and index bytes of zones; one row comes back.

    An edge of width ``w`` and height ``h`` touches at most ``(w + 2h) / c + 4``
    cells, a box of ``W`` by ``H`` has at most ``(W / c + 2) (H / c + 2)``.
    """
    length = "aggregate(_edges, 0.0D, (a, e) -> a + abs(e.x2 - e.x1) + 2 * (e.y2 - e.y1))"
    cells = "(_box.east - _box.west) / _c + 2", "(_box.north - _box.south) / _c + 2"
    touched = f"({length} / _c + 4 * size(_edges))"
    found = gridded(zones, rings, cell).withColumn("_edges", edge_list(rings)).agg(
        F.expr("collect_set(struct(_level, _c)) AS sizes"),
        F.expr(f"sum({touched} * {_CELL_BYTES + _EDGE_BYTES} + ({cells[0]}) * ({cells[1]}) * {_CELL_BYTES}) AS bytes"),
    ).first()
    return ZoneSummary({r["_level"]: r["_c"] for r in found["sizes"]}, found["bytes"] or 0.0)


def x_within(first_row: str, last_row: str) -> tuple[str, str]:
    """SQL: least and greatest x of an edge (x1, y1, x2, y2) inside row ``cy`` of a grid of size ``_c``."""
    # a hair wider than the row, as a cell's border need not be a number of the machine
    ends = "greatest(y1, (cy - 1e-6D) * _c)", "least(y2, (cy + 1.000001D) * _c)"
    at = [f"if(y1 = y2, {level}, x1 + ({y} - y1) * (x2 - x1) / (y2 - y1))" for y, level in zip(ends, ("x1", "x2"), strict=True)]
    reached = ", ".join((*at, f"if({first_row} = cy, x1, null)", f"if({last_row} = cy, x2, null)"))
    return f"least({reached})", f"greatest({reached})"


def _edges_by_cell(zones: DataFrame, zone_id: str, rings: str, cell: float | None) -> DataFrame:
    """Every edge with every cell it touches: (zone, _level, _c, cy, cx, edge ends, first and last row, last column)."""
    edges = gridded(zones, rings, cell).select(F.col(f"`{zone_id}`"), "_level", "_c", F.inline(edge_list(rings)))
    in_rows = edges.selectExpr("*", "floor(y1 / _c) AS _r1", "floor(y2 / _c) AS _r2").selectExpr("*", "explode(sequence(_r1, _r2)) AS cy")

    low, high = x_within("_r1", "_r2")
    pieces = in_rows.selectExpr("*", f"floor({low} / _c) AS _west", f"floor({high} / _c) AS _east")
    # all that belongs to a row of a zone meets in one place: cells, running counts and runs need no further shuffle
    pieces = pieces.repartition(F.col(f"`{zone_id}`"), "_level", "cy")
    return pieces.selectExpr("*", "explode(sequence(_west, _east)) AS cx")


def _step(x: str, y: str, row: str) -> str:
    """SQL: the y at which an end of an edge changes the count, if it lies in the row and west of the cell."""
    return f"if({row} = cy AND floor({x} / _c) < cx, {y}, double('infinity'))"


def grid_entries(zones: DataFrame, zone_id: str, rings: str, cell: float | None = None) -> DataFrame:
    """Border cells with all edges that touch them, and cells inside: (zone, _level, cy, cx, odd, edges).

    ``odd`` is the count along the row; a cell without edges is inside. A zone is
    one row. A row of its grid has about the square root of its number of edges
    in cells at most.
    """
    edge = f"named_struct('x1', x1, 'y1', y1, 'x2', x2, 'y2', y2, 't1', {_step('x1', 'y1', '_r1')}, 't2', {_step('x2', 'y2', '_r2')})"
    by_cell = _edges_by_cell(zones, zone_id, rings, cell).groupBy(f"`{zone_id}`", "_level", "cy", "cx").agg(
        F.expr(f"collect_list({edge}) AS edges"),
        F.expr("sum(if(cx = _east AND _r1 < cy AND _r2 >= cy, 1, 0)) AS ends"),
    )
    along = Window.partitionBy(f"`{zone_id}`", "_level", "cy").orderBy("cx")
    counted = by_cell.select(
        "*", F.coalesce(F.sum("ends").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("west"), F.lead("cx").over(along).alias("next"),
    )
    border = "array(named_struct('cx', cx, 'odd', west % 2 = 1, 'edges', edges))"
    run = "transform(sequence(cx + 1, next - 1), c -> named_struct('cx', c, 'odd', true, 'edges', slice(edges, 1, 0)))"
    return counted.selectExpr(
        f"`{zone_id}`", "_level", "cy", f"inline(if((west + ends) % 2 = 1 AND next > cx + 1, concat({border}, {run}), {border}))",
    )


def zone_cells(zones: DataFrame, cell: float | None = None, zone_id: str = "zone_id", rings: str = "rings") -> DataFrame:
    """The grid index of the zones for points: (zone, _cell, odd, e0.., more), a zone a row.

    A cell has its first edges in columns of their own, where the test compiles
    to plain arithmetic; only what goes beyond is an array. Edges that can change
    no count are left out.
    """
    entries = grid_entries(zones, zone_id, rings, cell)
    entries = computed_once(entries.withColumnRenamed("edges", "_all"), edges=F.expr("filter(_all, e -> e.y1 < e.y2 OR e.t1 <> e.t2)"))
    return entries.where("odd OR size(edges) > 0").selectExpr(
        f"`{zone_id}`", f"{cell_key('_level', 'cx', 'cy')} AS _cell", "odd",
        *[f"get(edges, {i}) AS e{i}" for i in range(FLAT_EDGES)],
        f"if(size(edges) > {FLAT_EDGES}, slice(edges, {FLAT_EDGES + 1}, size(edges)), null) AS more",
    )


def count_of(e: str, x: str, y: str) -> str:
    """SQL: what an edge of the cell adds to the count at a point."""
    west = f"{e}.x1 + ({y} - {e}.y1) * ({e}.x2 - {e}.x1) / ({e}.y2 - {e}.y1) <= {x}"
    return f"if({e}.y1 <= {y} AND {y} < {e}.y2 AND {west}, 1, 0) + if({e}.t1 <= {y}, 1, 0) + if({e}.t2 <= {y}, 1, 0)"


def covering(candidates: DataFrame, columns: list[str], x: str, y: str) -> DataFrame:
    """The candidates whose zone covers the point.

    The edges in columns are tested where generated code still runs; the rare
    array comes after, in a filter of its own.
    """
    first = " + ".join(count_of(f"e{i}", x, y) for i in range(FLAT_EDGES))
    tested = computed_once(candidates, _odd=F.expr(f"(if(odd, 1, 0) + {first}) % 2 = 1"))
    rest = f"aggregate(more, 0, (a, e) -> a + {count_of('e', x, y)}) % 2 = 1"
    return tested.where(f"_odd != if(more IS NULL, false, {rest})").select(*columns)


def placed(points: DataFrame, sizes: dict[int, float], x: str, y: str) -> DataFrame:
    """``points`` with ``_cell``, once for each grid size."""
    keys = [point_key(str(level), f"{size!r}D", x, y) for level, size in sorted(sizes.items())]
    if len(keys) == 1:
        return points.withColumn("_cell", F.expr(keys[0]))
    return points.select("*", F.explode(F.expr(f"array({', '.join(keys)})")).alias("_cell"))


def point_in_zone(
    points: DataFrame,
    zones: DataFrame,
    cell: float | None = None,
    lon: str = "lon",
    lat: str = "lat",
    zone_id: str = "zone_id",
    rings: str = "rings",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Each point with the zone that covers it; points in no zone drop out.

    Zones that overlap each get the point. The index is broadcast if its bound
    fits, and the points then stay where they are. Beyond that both sides are
    shuffled by cell, and adaptive execution splits a cell that holds too many
    points.
    """
    summary = summarise_zones(zones, zone_id, rings, cell)
    if not summary.sizes:
        return points.where("false").select("*", F.lit(None).cast(zones.schema[zone_id].dataType).alias(zone_id))
    index = zone_cells(zones, cell, zone_id, rings)
    index = F.broadcast(index) if summary.index_bytes <= broadcast_bytes else index.hint("shuffle_merge")
    x, y = f"`{lon}`", f"`{lat}`"
    there = evaluated(points, *dict.fromkeys((lon, lat))).where(f"{x} IS NOT NULL AND {y} IS NOT NULL AND NOT isnan({x}) AND NOT isnan({y})")
    return covering(placed(there, summary.sizes, x, y).join(index, "_cell"), [*points.columns, zone_id], x, y)


def zonal_stats(
    pixels: DataFrame,
    zones: DataFrame,
    cell: float | None = None,
    value: str = "avg_rad",
    day: str = "date",
    zone_id: str = "zone_id",
    rings: str = "rings",
    sample: bool = False,
    pixel_size: float | None = None,
    pixel_origin: tuple[float, float] = (0.0, 0.0),
    **place,
) -> DataFrame:
    """Mean, min, max and standard deviation of the pixels of each zone and month.

    A pixel counts whole if its centre is in the zone. With ``pixel_size`` it is
    the square of that side in a raster from ``pixel_origin`` that holds the
    coordinates, and counts in mean and deviation (of the population) by the
    share of it that lies in the zone; the least and greatest are over all pixels
    with a share.

    A missing or NaN value does not count. Zones without pixels have no row; see
    :func:`all_zone_months` for those. Only the zone id travels with the pixels,
    other zone columns are joined to the result.
    """
    v = F.col(value)
    slim = pixels.where(v.isNotNull() & ~F.isnan(v)).select(
        *dict.fromkeys([place.get("lon", "lon"), place.get("lat", "lat")]),
        F.trunc(day, "month").alias("_month"),
        v.cast("double").alias("_v"),
    )
    if pixel_size is not None:
        if sample:
            raise ValueError("a weighted deviation is that of the population")
        return _weighted_stats(slim, zones.select(zone_id, rings), pixel_size, pixel_origin, zone_id, rings, place.get("lon", "lon"), place.get("lat", "lat"))
    spread = F.stddev_samp("_v") if sample else F.stddev_pop("_v")
    return (
        point_in_zone(slim, zones.select(zone_id, rings), cell, zone_id=zone_id, rings=rings, **place)
        .groupBy(zone_id, "_month")
        .agg(
            F.avg("_v").alias("mean"), F.min("_v").alias("min"),
            F.max("_v").alias("max"), spread.alias("stdDev"),
        )
        .select(zone_id, month_label("_month").alias("date"), "mean", "min", "max", "stdDev")
    )


def _weighted_stats(
    slim: DataFrame, zones: DataFrame, size: float, origin: tuple[float, float], zone_id: str, rings: str, lon: str, lat: str
) -> DataFrame:
    from .coverage import pixel_weights, pixels_by_zone

    weights = pixel_weights(zones, size, origin, zone_id, rings)
    met = pixels_by_zone(slim, weights, size, origin, lon, lat, zone_id)
    sums = met.groupBy(zone_id, "_month").agg(
        F.sum("weight").alias("_w"), F.sum(F.col("weight") * F.col("_v")).alias("_wv"), F.sum(F.col("weight") * F.col("_v") * F.col("_v")).alias("_wvv"),
        F.min("_v").alias("min"), F.max("_v").alias("max"),
    )
    mean = F.col("_wv") / F.col("_w")
    variance = F.greatest(F.col("_wvv") / F.col("_w") - mean * mean, F.lit(0.0))
    return sums.select(zone_id, month_label("_month").alias("date"), mean.alias("mean"), "min", "max", F.sqrt(variance).alias("stdDev"))


def all_zone_months(zones: DataFrame, months, rings: str = "rings") -> DataFrame:
    """Every zone, its polygon left out, with every month of a spine (an array column)."""
    return (
        zones.drop(rings).withColumn("_day", F.explode(months))
        .withColumn("date", month_label("_day")).drop("_day")
    )
