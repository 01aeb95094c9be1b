"""Stations, polygons, night lights."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import AOIS
from ..functions import bbox, center_or_point, month_label, parse_rings
from ..operators import (
    collapse, in_bbox, month_spine, pixel_weights, pixels_by_zone, point_in_zone, stack, tagged, zonal_stats,
)
from ..session import scratch
from ..sinks import save_theme
from ..sources import MAP_ELEMENT, features_to_zones, read_paged_json, read_zones
from . import inputs
from .jobs import clean_night_lights, night_light_blocks, night_light_history, rail_stations, zone_blocks
from .registry import query, table

_ELEMENTS = """
elements AS (
    SELECT c_custkey AS osm_id, ['node', 'way', 'relation'][c_custkey % 3 + 1] AS kind,
           CASE WHEN c_custkey % 100 = 3 THEN 0.0 ELSE 34.0 + (c_custkey * 37 % 1280) * 0.0078125 END::DOUBLE AS lat,
           (-11.0 + (c_custkey * 53 % 2048) * 0.0078125)::DOUBLE AS lon,
           CASE WHEN c_custkey % 10 <> 0 THEN 'Estación ' || c_custkey END AS name,
           CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'railway:station'
                WHEN c_mktsegment = 'HOUSEHOLD' THEN 'station:rail' ELSE 'railway:halt' END AS tag,
           c_mktsegment AS segment
    FROM customer
), stations AS (
    SELECT * FROM elements WHERE tag = 'railway:station' OR (kind = 'node' AND tag = 'station:rail')
)"""
_TAGS = """
'{"segment":"' || segment || '","' || split_part(tag, ':', 1) || '":"' || split_part(tag, ':', 2) || '",'
    || CASE WHEN name IS NOT NULL THEN '"name":"' || name || '"' ELSE '"ref":"' || osm_id || '"' END || '}' AS tags"""


@query("WITH " + _ELEMENTS + " SELECT osm_id, kind FROM stations")
def stations_by_tag(spark, sf_dir):
    return tagged(inputs.map_elements(spark, sf_dir)).select(F.col("id").alias("osm_id"), F.col("type").alias("kind"))


@query("WITH " + _ELEMENTS + " SELECT osm_id, lat, lon FROM elements WHERE lat BETWEEN 40.2 AND 40.6 AND lon BETWEEN -3.9 AND -3.3")
def points_in_box(spark, sf_dir):
    placed = inputs.map_elements(spark, sf_dir).select(
        F.col("id").alias("osm_id"),
        center_or_point("lat", "center.lat").alias("lat"),
        center_or_point("lon", "center.lon").alias("lon"),
    )
    return in_bbox(placed, "lat", "lon", (40.2, -3.9, 40.6, -3.3))


@query(
    "WITH " + _ELEMENTS + " SELECT osm_id, name, lat, lon, " + _TAGS
    + " FROM stations WHERE lat BETWEEN 36.0 AND 43.8 AND lon BETWEEN -9.5 AND 3.3"
)
def rail_station_table(spark, sf_dir):
    """Landed pages of elements, then tags, coordinates and box."""
    elements = inputs.map_elements(spark, sf_dir)
    path = scratch(spark, "elements")
    inputs.paged(elements, F.floor(F.col("id") / 500), "elements").write.json(path)
    landed = read_paged_json(spark, path, MAP_ELEMENT, items="elements", one_page_per_line=True)
    return rail_stations(landed, AOIS["peninsula"])


@query("WITH " + _ELEMENTS + " SELECT osm_id, lat, lon FROM elements")
def element_coordinates(spark, sf_dir):
    return inputs.map_elements(spark, sf_dir).select(
        F.col("id").alias("osm_id"),
        center_or_point("lat", "center.lat").alias("lat"),
        center_or_point("lon", "center.lon").alias("lon"),
    )


@query(
    """
SELECT s_suppkey, 36.0::DOUBLE + s_suppkey % 10 AS south, -9.5::DOUBLE - s_suppkey AS west,
       36.5::DOUBLE + s_suppkey % 10 AS north, -9.25::DOUBLE - s_suppkey AS east, 2::INTEGER AS rings
FROM supplier"""
)
def wkt_boxes(spark, sf_dir):
    """A polygon with a hole as text, per supplier."""
    k = F.col("s_suppkey")
    west, south = F.lit(-9.5) - k, F.lit(36.0) + k % 10

    def ring(dx: float, dy: float):
        pairs = [(0, 0), (dx, 0), (dx, dy), (0, dy), (0, 0)]
        return F.concat_ws(", ", *[F.concat_ws(" ", west + x, south + y) for x, y in pairs])

    wkt = F.concat(F.lit("POLYGON(("), ring(0.25, 0.5), F.lit("), ("), ring(0.125, 0.125), F.lit("))"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", parse_rings(wkt).alias("r")).select(
        "s_suppkey", bbox("r")["south"].alias("south"), bbox("r")["west"].alias("west"),
        bbox("r")["north"].alias("north"), bbox("r")["east"].alias("east"), F.size("r").alias("rings"),
    )


# --- zones

_CORNERS = """
side AS (SELECT 0.25::DOUBLE * pow(0.5, """ + " + ".join(f"CASE WHEN max(s_suppkey) >= {1280 * 4**j} THEN 1 ELSE 0 END" for j in range(12)) + """) AS side FROM supplier),
corners AS (
    SELECT s_suppkey AS k, s_name, side, -10.0::DOUBLE + (s_suppkey % CAST(10 / side AS BIGINT)) * side AS x0,
           36.0::DOUBLE + (s_suppkey // CAST(10 / side AS BIGINT)) * side AS y0
    FROM supplier, side
)"""
_ZONES = _CORNERS + """,
edges AS (
    SELECT k, x0, y0, side, sign, x0 + dx1 * side AS x1, y0 + dy1 * side AS y1, x0 + dx2 * side AS x2, y0 + dy2 * side AS y2
    FROM corners, (VALUES
        (0::DOUBLE, 0::DOUBLE, 1::DOUBLE, 0::DOUBLE, false, 0), (1, 0, 1, 1, false, -1), (0.5, 0.5, 1, 1, false, 1),
        (0.5, 0.5, 0, 1, false, -1), (0, 0, 0, 1, false, 1),
        (0.375, 0.125, 0.5, 0.125, true, 0), (0.5, 0.125, 0.5, 0.25, true, 1), (0.375, 0.25, 0.5, 0.25, true, 0),
        (0.375, 0.125, 0.375, 0.25, true, -1)) v(dx1, dy1, dx2, dy2, hole, sign)
    WHERE NOT hole OR k % 3 = 0
)"""
def _pixels(lat_steps: str, one_row: str) -> str:
    return f"""
pixels AS (
    SELECT row_number() OVER () AS id, CAST(l_shipdate AS DATE) AS date, nullif(l_quantity, 13.0) AS avg_rad,
           CASE WHEN l_partkey % 3 = 0 THEN -10.0::DOUBLE + (a % 256) / 256.0::DOUBLE * side
                ELSE -10.5::DOUBLE + (a % 11264) / 1024.0::DOUBLE END AS lon,
           CASE WHEN l_partkey % 3 = 0 THEN 36.0::DOUBLE + (b % 256) / 256.0::DOUBLE * side
                ELSE 35.5::DOUBLE + (b % {lat_steps}) / 1024.0::DOUBLE END AS lat
    FROM (SELECT *, l_orderkey * 37 + l_partkey * 13 + l_linenumber * 101 AS a,
                    l_orderkey * 53 + l_partkey * 29 + l_linenumber * 7 AS b FROM lineitem), {one_row}
)"""


_PIXELS = _pixels("9216", "side")
# Over the land that has zones, and half a degree around it.
_LAND_PIXELS = """
land AS (SELECT CAST(ceil((max(y0 + side) - 35) * 1024) AS BIGINT) AS lat_steps FROM corners),""" + _pixels("lat_steps", "side, land")
_HITS = """
hits AS (
    SELECT p.id, e.k FROM pixels p JOIN edges e
      ON p.lat >= e.y1 AND p.lat < e.y2 AND p.lon < e.x1 + (p.lat - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1)
     AND p.lon >= e.x0
    GROUP BY p.id, e.k HAVING count(*) % 2 = 1
)"""
# Share of a pixel's square (side 1/128, corners at 1/512 past its multiples) in a zone: a sum over the zone's edges.
_SHARES = """
squares AS (
    SELECT *, floor((lon - 0.001953125::DOUBLE) * 128) AS px, floor((lat - 0.001953125::DOUBLE) * 128) AS py FROM pixels WHERE avg_rad IS NOT NULL
), cut AS (
    SELECT id, k, date, avg_rad, sign, (x1 - 0.001953125) * 128 - px AS u1, (x2 - 0.001953125) * 128 - px AS u2,
           (y1 - 0.001953125) * 128 - py AS v1, (y2 - 0.001953125) * 128 - py AS v2
    FROM squares p JOIN edges e ON sign <> 0 AND (x0 - 0.001953125) * 128 < px + 1 AND (x0 + side - 0.001953125) * 128 > px
     AND (y0 - 0.001953125) * 128 < py + 1 AND (y0 + side - 0.001953125) * 128 > py
), clipped AS (
    SELECT *, u1 + (greatest(v1, 0) - v1) * (u2 - u1) / (v2 - v1) AS ua, u1 + (least(v2, 1) - v1) * (u2 - u1) / (v2 - v1) AS ub
    FROM cut WHERE greatest(v1, 0) < least(v2, 1)
), weights AS (
    SELECT id, k, date, avg_rad, sum(sign * (least(v2, 1) - greatest(v1, 0)) * CASE WHEN abs(ub - ua) < 1e-12 THEN 1 - greatest(0, least(1, ua))
        ELSE ((least(ub, 0) + greatest(0, least(1, ub)) - greatest(0, least(1, ub)) ** 2 / 2)
            - (least(ua, 0) + greatest(0, least(1, ua)) - greatest(0, least(1, ua)) ** 2 / 2)) / (ub - ua) END) AS w
    FROM clipped GROUP BY ALL
)"""
_STATS = """
stats AS (
    SELECT 'ES_' || k AS zone_id, strftime(date, '%Y-%m') AS date, avg(avg_rad) AS mean, min(avg_rad) AS min,
           max(avg_rad) AS max, round(stddev_pop(avg_rad), 6) AS "stdDev"
    FROM hits JOIN pixels USING (id) WHERE avg_rad IS NOT NULL GROUP BY ALL
)"""


def _zones(spark, sf_dir):
    return features_to_zones(inputs.zone_features(spark, sf_dir), inputs.ZONE_PROPERTIES)


def _rounded(df):
    return df.withColumn("stdDev", F.round("stdDev", 6))


@query(
    "WITH " + _CORNERS + """
SELECT 'ES_' || s_suppkey AS zone_id, supplier.s_name AS "LAU_NAME",
       CASE WHEN s_suppkey % 3 = 0 THEN 2 ELSE 1 END::INTEGER AS rings,
       CASE WHEN s_suppkey % 3 = 0 THEN 11 ELSE 6 END::INTEGER AS points,
       x0 AS west, y0 + side AS north
FROM corners JOIN supplier ON s_suppkey = k"""
)
def zone_scan(spark, sf_dir):
    """Features landed one per line."""
    path = scratch(spark, "zones")
    features = inputs.zone_features(spark, sf_dir)
    features.select(inputs.bare_coordinates(F.to_json(F.struct("type", "properties", "geometry"))).alias("value")).write.text(path)
    zones = read_zones(spark, path, inputs.ZONE_PROPERTIES, one_feature_per_line=True)
    return zones.select(
        "zone_id", "LAU_NAME", F.size("rings").alias("rings"), F.size(F.flatten("rings")).alias("points"),
        bbox("rings")["west"].alias("west"), bbox("rings")["north"].alias("north"),
    )


@query(
    "WITH " + _ZONES + "," + _LAND_PIXELS + "," + _HITS + """
SELECT 'ES_' || k AS zone_id, lon, lat, count(*) AS points FROM hits JOIN pixels USING (id) GROUP BY ALL"""
)
def points_in_zones(spark, sf_dir):
    pixels = inputs.pixels(spark, sf_dir, inputs.land_steps(spark, sf_dir))
    found = point_in_zone(pixels, _zones(spark, sf_dir).select("zone_id", "rings"))
    return found.groupBy("zone_id", "lon", "lat").agg(F.count(F.lit(1)).alias("points"))


@query("WITH " + _ZONES + "," + _PIXELS + "," + _HITS + ", " + _STATS + " SELECT * FROM stats")
def zonal_statistics(spark, sf_dir):
    return _rounded(zonal_stats(inputs.pixels(spark, sf_dir), _zones(spark, sf_dir)))


@query("WITH " + _ZONES + "," + _PIXELS + "," + _HITS + ", " + _STATS + " SELECT * FROM stats")
def zonal_statistics_shuffled(spark, sf_dir):
    """The way taken when the zones do not fit a broadcast."""
    return _rounded(zonal_stats(inputs.pixels(spark, sf_dir), _zones(spark, sf_dir), broadcast_bytes=0))


@query(
    "WITH " + _ZONES + "," + _PIXELS + "," + _SHARES + """
SELECT 'ES_' || k AS zone_id, strftime(date, '%Y-%m') AS date, round(sum(w * avg_rad) / sum(w), 6) AS mean, min(avg_rad) AS min, max(avg_rad) AS max,
       round(sqrt(greatest(sum(w * avg_rad * avg_rad) / sum(w) - (sum(w * avg_rad) / sum(w)) ** 2, 0)), 5) AS "stdDev", round(sum(w), 6) AS pixels
FROM weights WHERE w > 1e-9 GROUP BY ALL"""
)
def zonal_statistics_weighted(spark, sf_dir):
    """Pixels count by the share of their square that lies in the zone."""
    size, origin = 1 / 128, (1 / 512, 1 / 512)
    pixels, zones = inputs.pixels(spark, sf_dir), _zones(spark, sf_dir).select("zone_id", "rings")
    stats = zonal_stats(pixels, zones, pixel_size=size, pixel_origin=origin)
    weights = pixels_by_zone(pixels.where("avg_rad IS NOT NULL"), pixel_weights(zones, size, origin), size, origin)
    shares = weights.groupBy("zone_id", month_label("date").alias("date")).agg(F.round(F.sum("weight"), 6).alias("pixels"))
    return stats.join(shares, ["zone_id", "date"]).withColumns({"mean": F.round("mean", 6), "stdDev": F.round("stdDev", 5)})


@query(
    "WITH " + _ZONES + "," + _PIXELS + "," + _HITS + ", " + _STATS + """
SELECT 'ES_' || s_suppkey AS zone_id, m.date, mean, min, max, "stdDev", s_name AS "LAU_NAME"
FROM supplier CROSS JOIN (
    SELECT strftime(unnest(generate_series(TIMESTAMP '1997-01-01', TIMESTAMP '1998-12-01', INTERVAL 1 MONTH)), '%Y-%m') AS date
) m LEFT JOIN stats ON zone_id = 'ES_' || s_suppkey AND stats.date = m.date"""
)
def night_light_history_table(spark, sf_dir):
    """Two years, every zone and month, zone names attached."""
    return _rounded(
        night_light_history(
            inputs.pixels(spark, sf_dir), _zones(spark, sf_dir), month_spine(1997, 1998), all_zones=True
        )
    )


@query(
    "WITH " + _ZONES + "," + _PIXELS + "," + _HITS + ", " + _STATS + """
SELECT 'ES_' || s_suppkey AS zone_id, m.date, mean, min, max, "stdDev", s_name AS "LAU_NAME"
FROM supplier CROSS JOIN (
    SELECT strftime(unnest(generate_series(TIMESTAMP '1997-01-01', TIMESTAMP '1998-12-01', INTERVAL 1 MONTH)), '%Y-%m') AS date
) m LEFT JOIN stats ON zone_id = 'ES_' || s_suppkey AND stats.date = m.date"""
)
def night_light_history_resumed(spark, sf_dir):
    """Half of the zones landed by a first run, the rest by a second; then the themed table from all blocks."""
    pixels, zones, months = inputs.pixels(spark, sf_dir), _zones(spark, sf_dir), month_spine(1997, 1998)
    path = scratch(spark, "history")
    early = zone_blocks(zones, 4).where("block < 2").drop("block")
    night_light_blocks(spark, pixels, early, months, path, blocks=4, at_once=2)
    whole = night_light_blocks(spark, pixels, zones, months, path, blocks=4, at_once=2)
    return _rounded(spark.read.parquet(save_theme(whole, "luz_nocturna", "historia", path, fmt="parquet")))


# --- night-light cleaning

_LIGHTS = """
lights AS (
    SELECT CASE WHEN l_linenumber <> 1 THEN 'Lugar ' || (l_suppkey % 50) END AS municipio,
           strftime(l_shipdate, '%Y-%m') AS date, nullif(l_quantity, 13.0) AS mean,
           CAST(round(l_extendedprice * 100) AS BIGINT) AS max,
           l_orderkey * 1000000000 + l_linenumber * 100000000 + l_suppkey AS row_order
    FROM lineitem
)"""


@query(
    "WITH " + _LIGHTS + """
SELECT municipio, date, avg(mean) AS mean, avg(max) AS max FROM lights
WHERE municipio IS NOT NULL GROUP BY municipio, date"""
)
def night_light_clean(spark, sf_dir):
    return clean_night_lights(inputs.night_light_rows(spark, sf_dir), "row_order")


@query(
    "WITH " + _LIGHTS + """
SELECT date, avg(mean) AS mean, avg(max) AS max,
       arg_min(municipio, row_order) FILTER (municipio IS NOT NULL) AS municipio
FROM lights GROUP BY date"""
)
def night_light_clean_by_date(spark, sf_dir):
    """All municipalities of a month in one row."""
    return clean_night_lights(inputs.night_light_rows(spark, sf_dir), "row_order", keys=["date"])


@query(
    """
SELECT l_orderkey, l_linenumber, avg(l_quantity) AS l_quantity, avg(CAST(round(l_extendedprice * 100) AS BIGINT)) AS price,
       arg_min(l_returnflag, l_suppkey * 1000 + ascii(l_returnflag)) AS l_returnflag
FROM lineitem GROUP BY l_orderkey, l_linenumber"""
)
def collapse_order_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", inputs.cents("l_extendedprice").alias("price"), "l_returnflag",
        (F.col("l_suppkey") * 1000 + F.ascii("l_returnflag")).alias("row_order"),
    )
    return collapse(lines, ["l_orderkey", "l_linenumber"], "l_returnflag", "row_order")


@query(
    """
SELECT event_id AS id, event_type AS label, value, NULL::VARCHAR AS props FROM events WHERE event_id % 2 = 0
UNION ALL SELECT event_id, event_type, NULL, props FROM events WHERE event_id % 2 = 1 OR event_id % 3 = 0"""
)
def stacked_parts(spark, sf_dir):
    """Columns in another order, one missing on each side."""
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"), F.col("event_type").alias("label"), "value", "props"
    )
    return stack([
        events.where("id % 2 = 0").select("id", "label", "value"),
        events.where("id % 2 = 1 OR id % 3 = 0").select("props", "label", "id"),
    ])
