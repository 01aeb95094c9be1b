"""Product catalogue: pages, columns, filters, order, assets."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..fixed_values import AOIS, ASSET_GLOBS, LEAD_COLUMNS
from ..functions import any_attr_le, attr, bbox, fallback, geojson_rings, identifier, level
from ..operators import (
    any_attribute_le, asset_patterns, counts, flat_products, flatten, in_window, intersects_aoi, keep, lead_columns,
    name_filter, outcomes, page, product_columns, select_assets, standardise_names, with_areas,
)
from ..operators.assets import glob_regex as _regex
from ..session import scratch
from ..sources import CATALOGUE_ITEM, flatten_open, read_open_items, read_paged_json
from . import inputs
from .jobs import asset_run, catalogue_run, matched_and_returned, product_catalogue
from .registry import query, table

def _triangle(x: str, y: str) -> str:
    return f"'[[' || {x} || ',' || {y} || '],[' || ({x} + 1) || ',' || {y} || '],[' || {x} || ',' || ({y} + 1) || '],[' || {x} || ',' || {y} || ']]'"


# The same catalogue on the SQL side, as flat columns.
_ITEMS = r"""
items AS (
    SELECT o_orderkey AS k, 'P' || o_orderkey AS "Id",
           CASE WHEN o_orderkey % 97 <> 0 THEN
               CASE o_orderstatus WHEN 'F' THEN 'S2A_MSIL2A_' WHEN 'O' THEN 'S2B_MSIL1C_' ELSE 'S1A_IW_GRDH_' END
               || 'T' || (o_orderkey % 60) || 'ABC_' || o_orderkey
               || CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE '.SAFE' END END AS "Name",
           o_orderdate + to_milliseconds(CASE WHEN o_orderkey % 50 = 0 THEN 0 WHEN o_orderkey % 50 = 1 THEN 86399999
                                         ELSE (o_orderkey * 7919) % 86400 * 1000 END) AS start,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.000Z') AS "IngestionDate",
           CAST(round(o_totalprice * 100) AS BIGINT) AS "sizeInBytes",
           -12.0::DOUBLE + (o_orderkey * 37 % 1024) * 0.015625::DOUBLE AS west,
           34.0::DOUBLE + (o_orderkey * 53 % 768) * 0.015625::DOUBLE AS south, o_orderkey % 7 = 0 AS two_parts,
           CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey % 101 AS DOUBLE) END AS cover,
           CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 90 + 0.5::DOUBLE ELSE CAST(o_orderkey % 100 AS DOUBLE) END AS cloud_attr,
           o_orderkey % 2 = 0 AND o_orderkey % 5 <> 0 AS cloud_by_value,
           CASE WHEN o_orderkey % 2 = 0 THEN 'VV' ELSE 'VV&VH' END AS polarizations,
           CASE WHEN o_orderstatus = 'P' THEN 'SENTINEL-1' ELSE 'SENTINEL-2' END AS collection
    FROM orders
),
shaped AS (
    SELECT *, coalesce(split_part("Name", '.', 1), "Id") AS identifier,
           strftime(start, '%Y-%m-%d %H:%M:%S.%g') AS content_start,
           coalesce(cover, cloud_attr) AS cloudcover,
           CASE WHEN two_parts THEN '{"type":"MultiPolygon","coordinates":[[' || """ + _triangle("west", "south") + """
                    || '],[' || """ + _triangle("(west + 3)", "(south + 2)") + """ || ']]}'
                ELSE '{"type":"Polygon","coordinates":[' || """ + _triangle("west", "south") + """ || ']}' END AS footprint,
           CASE WHEN "Name" LIKE '%L2A%' THEN 'L2A' ELSE 'unknown' END AS product_level,
           CASE WHEN k % 4 <> 0 THEN '[{"Type":"S3","S3Path":"/archive/ñ/' || k || '"}]' END AS s3_asset
    FROM items
)"""

_S2 = '"Id", "Name", identifier, content_start, "IngestionDate", cloudcover, "sizeInBytes", footprint, product_level, s3_asset'
_S1 = '"Id", "Name", identifier, content_start, "IngestionDate", polarizations, "sizeInBytes", footprint, s3_asset'

_WINDOW_BOTH = "start >= TIMESTAMP '1996-03-01 00:00:00' AND start <= TIMESTAMP '1996-06-30 23:59:59.999'"
_WINDOW_NEITHER = "start > TIMESTAMP '1996-03-01 00:00:00' AND start < TIMESTAMP '1996-06-30 00:00:00'"
_START, _END = date(1996, 3, 1), date(1996, 6, 30)

def _part_in_madrid(x: str, y: str) -> str:
    """A right-angled triangle and a box share a point."""
    return f"""({x} <= -3.3 AND {x} + 1 >= -3.9 AND {y} <= 40.6 AND {y} + 1 >= 40.2
    AND greatest({x}, -3.9::DOUBLE) + greatest({y}, 40.2::DOUBLE) <= {x} + {y} + 1)"""


_IN_MADRID = "(" + _part_in_madrid("west", "south") + " OR (two_parts AND " + _part_in_madrid("(west + 3)", "(south + 2)") + "))"


def _with_start(spark, sf_dir):
    """Start as a stored time stamp, as in a Parquet catalogue."""
    return inputs.catalogue_items(spark, sf_dir).withColumn(
        "content_start", F.col("ContentDate.Start").try_cast("timestamp")
    )


def _plain_start(df):
    return df.withColumn("content_start", F.date_format("content_start", "yyyy-MM-dd HH:mm:ss.SSS"))


def _landed_pages(spark, sf_dir):
    path = scratch(spark, "pages")
    inputs.catalogue_pages(spark, sf_dir).write.text(path)
    return path


@query(
    "WITH " + _ITEMS + """
SELECT "Id", "Name", content_start, "sizeInBytes", cover AS "CloudCover",
       CASE WHEN two_parts THEN 'MultiPolygon' ELSE 'Polygon' END AS kind,
       CASE WHEN two_parts THEN 2 ELSE 1 END::INTEGER AS rings, CASE WHEN two_parts THEN west + 4 ELSE west + 1 END AS east
FROM shaped"""
)
def paged_scan(spark, sf_dir):
    """Pages of 500 products, landed one page per line, read back as rows; footprints of both kinds in a page."""
    found = read_paged_json(spark, _landed_pages(spark, sf_dir), CATALOGUE_ITEM, one_page_per_line=True)
    rings = geojson_rings("GeoFootprint")
    return found.select(
        "Id", "Name",
        F.date_format(F.col("ContentDate.Start").try_cast("timestamp"), "yyyy-MM-dd HH:mm:ss.SSS").alias("content_start"),
        "sizeInBytes", "CloudCover", F.col("GeoFootprint.type").alias("kind"), rings.alias("rings"),
    ).select("*", bbox("rings")["east"].alias("east")).withColumn("rings", F.size("rings"))


@query(
    "WITH " + _ITEMS + """
SELECT "Id", "Name", strftime(start, '%Y-%m-%dT%H:%M:%S.%gZ') AS "ContentDate.Start",
       strftime(start + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S.%gZ') AS "ContentDate.End", "IngestionDate", "sizeInBytes",
       CASE WHEN two_parts THEN 'MultiPolygon' ELSE 'Polygon' END AS "GeoFootprint.type", cover AS "CloudCover", collection,
       CASE WHEN k % 13 = 0 THEN "IngestionDate" END AS "EvictionDate",
       CASE WHEN k % 3 = 0 THEN 'auto' END AS "Quality.Check level", CASE WHEN k % 6 = 0 THEN k % 10 END AS "Quality.Score",
       CASE WHEN two_parts THEN 2 ELSE 1 END::INTEGER AS parts, 4::INTEGER AS attributes
FROM shaped"""
)
def open_items(spark, sf_dir):
    """The same pages without a schema: every field that arrives is a column, arrays are counted here."""
    flat = flatten_open(read_open_items(spark, _landed_pages(spark, sf_dir), one_page_per_line=True))
    return flat.select(
        *[F.col(f"`{c}`") for c in flat.columns if c not in ("GeoFootprint.coordinates", "Attributes", "Assets")],
        F.size(F.try_variant_get("`GeoFootprint.coordinates`", "$", "array<variant>")).alias("parts"),
        F.size(F.try_variant_get("Attributes", "$", "array<variant>")).alias("attributes"),
    )


@query(
    "WITH " + _ITEMS + """
SELECT "Id", "Name", strftime(start, '%Y-%m-%dT%H:%M:%S.%gZ') AS "ContentDate_Start",
       strftime(start + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S.%gZ') AS "ContentDate_End",
       "sizeInBytes", CASE WHEN two_parts THEN 'MultiPolygon' ELSE 'Polygon' END AS "GeoFootprint_type"
FROM shaped"""
)
def flatten_items(spark, sf_dir):
    items = inputs.catalogue_items(spark, sf_dir).select("Id", "Name", "ContentDate", "sizeInBytes", "GeoFootprint")
    return flatten(items, sep="_").drop("GeoFootprint_coordinates")


@query(
    "WITH " + _ITEMS + """
SELECT "Id", "Name", strftime(start, '%Y-%m-%dT%H:%M:%S.%gZ') AS "ContentDate_Start",
       strftime(start + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S.%gZ') AS "ContentDate_End",
       identifier, content_start, "IngestionDate", "sizeInBytes", cover AS "CloudCover", collection
FROM shaped"""
)
def flat_catalogue(spark, sf_dir):
    items = inputs.catalogue_items(spark, sf_dir).drop("GeoFootprint", "Attributes", "Assets")
    return _plain_start(flat_products(items, sep="_"))


@query("SELECT p_partkey AS \"Id\", p_name AS \"Name\", p_brand, p_size AS \"ContentLength\" FROM part")
def lead_columns_first(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        "p_brand", F.col("p_size").alias("ContentLength"), F.col("p_name").alias("Name"), F.col("p_partkey").alias("Id")
    )
    return lead_columns(part, LEAD_COLUMNS)


@query("SELECT p_partkey, p_type FROM part")
def keep_columns(spark, sf_dir):
    return keep(table(spark, sf_dir, "part"), ["p_partkey", "not_there", "p_type"])


@query(
    """
SELECT s_suppkey, 's' || s_suppkey AS "date", 't' || s_suppkey AS "UPDATED", s_name AS municipio FROM supplier"""
)
def standard_names(spark, sf_dir):
    named = table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.concat(F.lit("s"), "s_suppkey").alias("StartDate"),
        F.concat(F.lit("t"), "s_suppkey").alias("UPDATED"),
        F.col("s_name").alias("LAU_NAME"),
    )
    return standardise_names(named, {"LAU_NAME": "municipio"})


@query("WITH " + _ITEMS + " SELECT collection, " + _S2 + " FROM shaped WHERE collection = 'SENTINEL-2'")
def products_sentinel2(spark, sf_dir):
    items = inputs.catalogue_items(spark, sf_dir).where("collection = 'SENTINEL-2'")
    return _plain_start(product_columns(items, "sentinel2"))


@query("WITH " + _ITEMS + " SELECT collection, " + _S1 + " FROM shaped WHERE collection = 'SENTINEL-1'")
def products_sentinel1(spark, sf_dir):
    items = inputs.catalogue_items(spark, sf_dir).where("collection = 'SENTINEL-1'")
    return _plain_start(product_columns(items, "sentinel1"))


@query("WITH " + _ITEMS + " SELECT \"Id\", content_start FROM shaped WHERE collection = 'SENTINEL-2' AND " + _WINDOW_BOTH)
def window_inclusive(spark, sf_dir):
    found = in_window(_with_start(spark, sf_dir), "SENTINEL-2", _START, _END, "both")
    return _plain_start(found.select("Id", "content_start"))


@query("WITH " + _ITEMS + " SELECT \"Id\", content_start FROM shaped WHERE collection = 'SENTINEL-1' AND " + _WINDOW_NEITHER)
def window_strict(spark, sf_dir):
    found = in_window(_with_start(spark, sf_dir), "SENTINEL-1", _START, _END, "neither")
    return _plain_start(found.select("Id", "content_start"))


@query(
    """
SELECT o_orderkey, o_orderstatus FROM orders
WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate <= TIMESTAMP '1996-06-30 23:59:59.999'"""
)
def window_stored(spark, sf_dir):
    """On a stored table both conditions reach the scan."""
    orders = table(spark, sf_dir, "orders")
    return in_window(
        orders, "F", _START, _END, start_col="o_orderdate", collection_col="o_orderstatus"
    ).select("o_orderkey", "o_orderstatus")


@query("WITH " + _ITEMS + " SELECT \"Id\", west, south FROM shaped WHERE " + _IN_MADRID)
def aoi_products(spark, sf_dir):
    items = inputs.catalogue_items(spark, sf_dir).select("Id", geojson_rings("GeoFootprint").alias("rings"))
    found = intersects_aoi(items, "rings", AOIS["madrid"])
    corner = F.col("rings")[0][0]
    return found.select("Id", corner["x"].alias("west"), corner["y"].alias("south"))


def _edges_sql(corners, x, y, k="k"):
    """Edges (lower end first) of a ring given by its corners."""
    pairs = zip(corners, corners[1:] + corners[:1])
    ordered = [(p, q) if p[1] <= q[1] else (q, p) for p, q in pairs]
    return " UNION ALL ".join(
        f"SELECT {k} AS k, {x} + {p[0]}::DOUBLE AS x1, {y} + {p[1]}::DOUBLE AS y1, {x} + {q[0]}::DOUBLE AS x2, {y} + {q[1]}::DOUBLE AS y2" for p, q in ordered
    )


# An arrow head of five corners per nation; every third has a hole.
_ARROW, _ARROW_HOLE = [(0, 0), (2, 0), (2, 2), (1, 1), (0, 2)], [(0.5, 0.25), (1.5, 0.25), (1.0, 0.75)]
_TRIANGLE = [(0, 0), (1, 0), (0, 1)]


def _side(s: str, px: str, py: str) -> str:
    return f"sign(({s}.x2 - {s}.x1) * ({py} - {s}.y1) - ({s}.y2 - {s}.y1) * ({px} - {s}.x1))"


_MEET = (
    "least(f.x1, f.x2) <= greatest(a.x1, a.x2) AND least(a.x1, a.x2) <= greatest(f.x1, f.x2) AND f.y1 <= a.y2 AND a.y1 <= f.y2"
    f" AND {_side('f', 'a.x1', 'a.y1')} * {_side('f', 'a.x2', 'a.y2')} <= 0 AND {_side('a', 'f.x1', 'f.y1')} * {_side('a', 'f.x2', 'f.y2')} <= 0"
)


def _corner_in(corner: str, edge: str) -> str:
    x, y = f"{corner}.x", f"{corner}.y"
    return (
        f"{edge}.y1 <= {y} AND {y} < {edge}.y2 AND {x} < {edge}.x1 + ({y} - {edge}.y1) * ({edge}.x2 - {edge}.x1) / ({edge}.y2 - {edge}.y1)"
    )


@query(
    "WITH " + _ITEMS + """,
corners AS (SELECT n_nationkey AS k, -12.5::DOUBLE + (n_nationkey % 5) * 3.25 AS x, 33.5::DOUBLE + (n_nationkey // 5) * 2.625 AS y FROM nation),
area_edges AS (""" + _edges_sql(_ARROW, "x", "y").replace("::DOUBLE AS y2", "::DOUBLE AS y2 FROM corners") + """
    UNION ALL """ + _edges_sql(_ARROW_HOLE, "x", "y").replace("::DOUBLE AS y2", "::DOUBLE AS y2 FROM corners WHERE k % 3 = 0") + """),
parts AS (SELECT k, west AS x, south AS y FROM items UNION ALL SELECT k, west + 3, south + 2 FROM items WHERE two_parts),
foot_edges AS (""" + _edges_sql(_TRIANGLE, "x", "y").replace("::DOUBLE AS y2", "::DOUBLE AS y2 FROM parts") + """),
heads AS (SELECT k, x, y FROM corners UNION ALL SELECT k, x + 0.5, y + 0.25 FROM corners WHERE k % 3 = 0),
links AS (
    SELECT f.k, a.k AS area FROM foot_edges f JOIN area_edges a ON """ + _MEET + """
    UNION SELECT k, area FROM (
        SELECT p.k, p.x, p.y, a.k AS area FROM parts p JOIN area_edges a ON """ + _corner_in("p", "a") + """
        GROUP BY ALL HAVING count(*) % 2 = 1)
    UNION SELECT k, area FROM (
        SELECT f.k, h.x, h.y, h.k AS area FROM heads h JOIN foot_edges f ON """ + _corner_in("h", "f") + """
        GROUP BY ALL HAVING count(*) % 2 = 1))
SELECT 'P' || k AS "Id", 'N' || area AS area_id FROM links"""
)
def products_in_areas(spark, sf_dir):
    """Every product with every area that it meets, for a table of concave areas, some with a hole."""
    k = F.col("n_nationkey")
    x, y = F.lit(-12.5) + k % 5 * 3.25, F.lit(33.5) + F.floor(k / 5) * 2.625

    def ring(corners):
        return F.array(*[F.struct((x + dx).alias("x"), (y + dy).alias("y")) for dx, dy in corners])

    rings = F.when(k % 3 == 0, F.array(ring(_ARROW), ring(_ARROW_HOLE))).otherwise(F.array(ring(_ARROW)))
    areas = table(spark, sf_dir, "nation").select(F.concat(F.lit("N"), "n_nationkey").alias("area_id"), rings.alias("rings"))
    items = inputs.catalogue_items(spark, sf_dir).select("Id", geojson_rings("GeoFootprint").alias("footprint"))
    return with_areas(items, "footprint", areas).select("Id", "area_id")


@query(
    "WITH " + _ITEMS + """
SELECT "Id", collection FROM shaped
WHERE collection = 'SENTINEL-1' OR (cloud_by_value AND cloud_attr <= 40)"""
)
def cloud_limit(spark, sf_dir):
    items = inputs.catalogue_items(spark, sf_dir)
    return any_attribute_le(items, 40).select("Id", "collection")


@query(
    "WITH " + _ITEMS + """
SELECT "Id", "Name" FROM shaped
WHERE "Name" LIKE '%T31ABC%' AND ("Name" NOT LIKE '%L1C%' OR collection = 'SENTINEL-1')"""
)
def tile_names(spark, sf_dir):
    return name_filter(inputs.catalogue_items(spark, sf_dir), include="T31ABC").select("Id", "Name")


@query("WITH " + _ITEMS + " SELECT \"Id\", cloud_attr AS cloud, polarizations AS polar, cloud_by_value AND cloud_attr <= 10 AS clear FROM shaped")
def first_attributes(spark, sf_dir):
    return inputs.catalogue_items(spark, sf_dir).select(
        "Id",
        attr("Attributes", "cloud").cast("double").alias("cloud"),
        attr("Attributes", "POLAR").alias("polar"),
        any_attr_le("Attributes", "CloudCover", 10).alias("clear"),
    )


@query("WITH " + _ITEMS + " SELECT \"Id\", cloudcover FROM shaped")
def cloud_fallback(spark, sf_dir):
    return inputs.catalogue_items(spark, sf_dir).select(
        "Id", fallback("CloudCover", attr("Attributes", "cloud").cast("double")).alias("cloudcover")
    )


@query(
    "WITH " + _ITEMS + """
SELECT product_level, collection, count(*) AS products, count(DISTINCT identifier) AS identifiers
FROM shaped GROUP BY ALL"""
)
def product_levels(spark, sf_dir):
    return (
        inputs.catalogue_items(spark, sf_dir)
        .groupBy(level("Name").alias("product_level"), "collection")
        .agg(
            F.count(F.lit(1)).alias("products"),
            F.count_distinct(identifier("Name", "Id")).alias("identifiers"),
        )
    )


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 1000 OFFSET 500")
def ordered_page(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    return page(orders, [F.desc("o_orderdate"), F.asc("o_orderkey")], top=500, max_pages=2, skip=500).drop("o_orderdate")


@query("SELECT count(*) AS total, least(count(*), 10000) AS returned FROM orders")
def row_counts(spark, sf_dir):
    return counts(table(spark, sf_dir, "orders"), top=500, max_pages=20)


@query(
    "WITH " + _ITEMS + " SELECT collection, " + _S2 + " FROM shaped WHERE collection = 'SENTINEL-2' AND "
    + _WINDOW_BOTH.replace("1996-06-30", "1999-06-30") + " AND " + _IN_MADRID + """
  AND "Name" NOT LIKE '%L1C%' AND cloud_by_value AND cloud_attr <= 80
ORDER BY start DESC, "Id" LIMIT 4"""
)
def product_catalogue_page(spark, sf_dir):
    items = inputs.catalogue_items(spark, sf_dir).withColumn("rings", geojson_rings("GeoFootprint"))
    found = product_catalogue(
        items, "sentinel2", "SENTINEL-2", _START, date(1999, 6, 30), aoi_rings="rings", aoi_wkt=AOIS["madrid"],
        max_cloud=80, exclude="L1C", top=2, max_pages=2,
    )
    return _plain_start(found)


@query(
    "WITH " + _ITEMS + " SELECT collection, " + _S1 + " FROM shaped WHERE collection = 'SENTINEL-1' AND "
    + _WINDOW_BOTH.replace("1996-06-30", "1999-06-30")
)
def product_catalogue_all(spark, sf_dir):
    """No page asked for: every product that matches."""
    items = inputs.catalogue_items(spark, sf_dir)
    return _plain_start(product_catalogue(items, "sentinel1", "SENTINEL-1", _START, date(1999, 6, 30)))


@query(
    "WITH " + _ITEMS + " SELECT count(*) AS total, least(count(*), 100) AS returned FROM shaped WHERE collection = 'SENTINEL-1' AND "
    + _WINDOW_BOTH.replace("1996-06-30", "1999-06-30")
)
def product_page_counts(spark, sf_dir):
    """What a page set of 100 leaves out."""
    items = inputs.catalogue_items(spark, sf_dir)
    return matched_and_returned(items, "SENTINEL-1", _START, date(1999, 6, 30), top=20, max_pages=5)


@query(
    "WITH " + _ITEMS + " SELECT count(*) AS total, least(count(*), 100) AS returned FROM shaped WHERE collection = 'SENTINEL-1' AND "
    + _WINDOW_BOTH.replace("1996-06-30", "1999-06-30")
)
def product_counts_written(spark, sf_dir):
    """The same counts, taken while the page set is written."""
    items = inputs.catalogue_items(spark, sf_dir)
    return catalogue_run(
        spark, items, "sentinel1", "SENTINEL-1", _START, date(1999, 6, 30), scratch(spark, "catalogue"), "sentinel1", top=20, max_pages=5,
    ).drop("path")


# --- archive members

_MEMBERS = """
members AS (
    SELECT l_orderkey, l_linenumber,
           CASE l_linenumber
             WHEN 1 THEN base || 'GRANULE/x/IMG_DATA/R' || res || 'm/T_' || band || '_' || res || 'm.jp2'
             WHEN 2 THEN base || 'IMG_DATA_R' || res || 'm/T_' || band || '.jp2'
             WHEN 3 THEN base || 'measurement/iw-' || band || '.tiff'
             WHEN 4 THEN base || 'manifest.safe'
             WHEN 5 THEN base || 'preview/quick-look.png'
             ELSE base || 'IMG_DATA/' || band || '.tiff' END AS member,
           'P' || l_orderkey AS product_id
    FROM (SELECT *, 'P' || l_orderkey || '.SAFE/' AS base,
                 ['10', '20', '60'][l_partkey % 3 + 1] AS res,
                 ['TCI', 'SCL', 'B04', 'B08', 'tci', 'PREVIEW'][l_suppkey % 6 + 1] AS band
          FROM lineitem)
)"""


def _globs_sql(globs: list[str]) -> str:
    return "(" + " OR ".join(f"member GLOB '{g}'" for g in globs) + ")"


_MODES = [("tci", None), ("scl", None), ("bands", [" b04", "B08 "]), ("all", None)]
_MODE_GLOBS = {m: ASSET_GLOBS[m] for m in ("tci", "scl", "all")}
_MODE_GLOBS["bands"] = [g.format(band=b) for b in ("B04", "B08") for g in ASSET_GLOBS["bands"]]
_MODE_GLOBS["sentinel-1"] = ASSET_GLOBS["sentinel-1"]


@query(
    "WITH " + _MEMBERS
    + " UNION ALL ".join(
        f" SELECT DISTINCT '{m}' AS mode, product_id, member FROM members WHERE {_globs_sql(g)}"
        for m, g in _MODE_GLOBS.items()
    )
)
def asset_selection(spark, sf_dir):
    """Every mode: members that any glob takes, made unique, then each mode is a filter."""
    modes = [(m, asset_patterns(m, bands)) for m, bands in _MODES]
    modes.append(("sentinel-1", asset_patterns("tci", None, "SENTINEL-1")))
    members = select_assets(inputs.archive_members(spark, sf_dir), [p for _, patterns in modes for p in patterns])
    chosen = F.filter(
        F.array(*[F.when(F.col("member").rlike(_regex(p)), F.lit(m)) for m, p in modes]), lambda m: m.isNotNull()
    )
    return members.select(F.explode(chosen).alias("mode"), "product_id", "member")


@query("WITH " + _MEMBERS + " SELECT DISTINCT product_id, member FROM members WHERE " + _globs_sql(ASSET_GLOBS["all"]))
def asset_selection_all(spark, sf_dir):
    return select_assets(inputs.archive_members(spark, sf_dir), asset_patterns("all"))


def _run_sql(chosen: str = "") -> str:
    return (
        _MEMBERS + """, batch AS (
    SELECT 'P' || o_orderkey AS product_id, o_orderkey AS k FROM orders WHERE o_orderkey % 4 <> 0""" + chosen + """
), found AS (
    SELECT product_id, count(DISTINCT member) AS assets FROM members WHERE """
        + _globs_sql(ASSET_GLOBS["tci"]) + """ GROUP BY product_id
), statuses AS (
    SELECT product_id, 'N' || k AS identifier,
           CASE WHEN assets > 0 THEN 'ok' ELSE 'N' || k || ': no assets matched' END AS status,
           coalesce(assets, 0) AS assets
    FROM batch LEFT JOIN found USING (product_id)
)"""
    )


_RUN = _run_sql("""
    ORDER BY o_orderdate DESC, 'P' || o_orderkey LIMIT 200""")
_RUN_ALL = _run_sql()
_OUTCOMES = " SELECT CASE WHEN status = 'ok' THEN 'ok' ELSE 'none' END AS status, count(*) AS products FROM statuses GROUP BY 1"


def _asset_run(spark, sf_dir, max_products=None):
    """Products not yet done (three in four), all or the next ``max_products``."""
    orders = table(spark, sf_dir, "orders")
    product = F.concat(F.lit("P"), "o_orderkey").alias("product_id")
    products = orders.select(
        product, F.concat(F.lit("N"), "o_orderkey", F.lit(".SAFE")).alias("Name"), F.col("o_orderdate").alias("content_start")
    )
    done = orders.where("o_orderkey % 4 = 0").select(product)
    return asset_run(products, inputs.archive_members(spark, sf_dir), done, "tci", max_products=max_products)


def _outcomes(statuses):
    return outcomes(statuses.withColumn("status", F.when(F.col("status") == "ok", "ok").otherwise("none")))


@query("WITH " + _RUN_ALL + " SELECT * FROM statuses")
def asset_run_statuses_all(spark, sf_dir):
    return _asset_run(spark, sf_dir)[1]


@query(
    "WITH " + _RUN_ALL + " SELECT DISTINCT product_id, member FROM members SEMI JOIN batch USING (product_id) WHERE "
    + _globs_sql(ASSET_GLOBS["tci"])
)
def asset_run_assets_all(spark, sf_dir):
    return _asset_run(spark, sf_dir)[0].select("product_id", "member")


@query("WITH " + _RUN_ALL + _OUTCOMES)
def run_outcomes_all(spark, sf_dir):
    return _outcomes(_asset_run(spark, sf_dir)[1])


@query("WITH " + _RUN + " SELECT * FROM statuses")
def asset_run_statuses(spark, sf_dir):
    """The run-size feature: the next 200 products."""
    return _asset_run(spark, sf_dir, max_products=200)[1]


@query("WITH " + _RUN + _OUTCOMES)
def run_outcomes(spark, sf_dir):
    return _outcomes(_asset_run(spark, sf_dir, max_products=200)[1])
