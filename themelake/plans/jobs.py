"""The composite jobs: landed data in, one tidy table per dataset out.

Each function takes and returns DataFrames; :func:`run_all` writes the results
by theme. Polygon texts are read while the plan is built (one small job), and a
zone join looks at the zones first to choose its way.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from ..functions import (
    box_of, center_or_point, extract_category, head_segment, identifier, json_text, normalise, rings_of,
)
from ..operators import (
    any_attribute_le, asset_patterns, collapse, complete, computed_once, counts, expand_daily,
    flat_products, in_bbox, in_window, intersects_aoi, lookup, name_filter, needs_refresh, page, pivot_mean,
    prefix, product_columns, restrict, select_assets, standardise_names, tagged, trailing_days,
    upsert, zonal_stats,
)
from ..operators.zonal import all_zone_months
from ..sinks import save_theme
from ..session import cut_lineage
from ..sources import decode_cube, decode_documents, explode_series, last_periods


def province_table(spark: SparkSession) -> DataFrame:
    rows = list(fixed.PROVINCE_OF.items())
    return spark.createDataFrame(rows, "municipio string, provincia string")


def clean_population(
    series: DataFrame,
    provinces: DataFrame,
    categories: list[str] = fixed.SEX_CATEGORIES,
    names: dict[str, str] = fixed.SEX_COLUMNS,
    unknown: str = fixed.UNKNOWN_PROVINCE,
    normalise_after: bool = False,
) -> DataFrame:
    """Municipal population: category from the title, pivot, province lookup.

    Names are normalised before the pivot so that two spellings meet in one row;
    ``normalise_after`` keeps them apart.
    """
    named = computed_once(
        series.where(F.col("municipio").isNotNull()).select(F.col("municipio").alias("_title"), "year", "population"),
        municipio=head_segment("_title") if normalise_after else normalise(head_segment("_title")),
        category=extract_category("_title", categories),
    )
    wide = pivot_mean(named, ["municipio", "year"], "category", "population", categories, names)
    if normalise_after:
        wide = wide.withColumn("municipio", normalise("municipio"))
    return lookup(wide, provinces, "municipio", "provincia", unknown)


def clean_night_lights(
    table: DataFrame, order_col: str, keys: list[str] | None = None, label: str = "municipio"
) -> DataFrame:
    """One row per municipality and month, means of the number columns.

    ``keys=["date"]`` folds all municipalities of a date into one row.
    """
    tidy = standardise_names(table, fixed.NIGHT_LIGHT_RENAMES)
    return collapse(tidy, keys or ["municipio", "date"], label, order_col)


def night_light_history(
    pixels: DataFrame,
    zones: DataFrame,
    months: Column,
    zone_id: str = "zone_id",
    cell: float | None = None,
    all_zones: bool = True,
    **columns,
) -> DataFrame:
    """Zonal statistics for the months of a spine, zone columns attached.

    Zones without pixels have their months too, with null statistics, unless
    ``all_zones`` is off.
    """
    first, last = F.array_min(months), F.add_months(F.array_max(months), 1)
    day = F.col(columns.get("day", "date"))
    stats = zonal_stats(pixels.where((day >= first) & (day < last)), zones, cell, zone_id=zone_id, **columns)
    if all_zones:
        return all_zone_months(zones, months).join(stats, [zone_id, "date"], "left")
    attributes = zones.drop("rings")
    return stats if attributes.columns == [zone_id] else stats.join(attributes, zone_id, "left")


def zone_blocks(zones: DataFrame, blocks: int, zone_id: str = "zone_id") -> DataFrame:
    """``zones`` with ``block``, a number below ``blocks`` that depends on the zone id alone."""
    return zones.withColumn("block", F.pmod(F.xxhash64(zone_id), F.lit(blocks)).cast("int"))


def pending_blocks(blocked: DataFrame, landed: DataFrame, zone_id: str = "zone_id") -> DataFrame:
    """(block, zones, print): blocks of zones that are not landed with just these zones; ``print`` tells sets of ids apart."""
    wanted = blocked.groupBy("block").agg(F.count(F.lit(1)).alias("zones"), F.bit_xor(F.xxhash64(F.lit("zone"), zone_id)).alias("print"))
    return wanted.join(landed, ["block", "zones", "print"], "left_anti")


def night_light_blocks(
    spark: SparkSession,
    pixels: DataFrame,
    zones: DataFrame,
    months: Column,
    path: str,
    blocks: int = 16,
    at_once: int = 4,
    zone_id: str = "zone_id",
    **options,
) -> DataFrame:
    """:func:`night_light_history`, landed block by block of zones under ``path``; all of it is returned.

    Blocks that an earlier run has landed are left out, so a run that died goes
    on where it was, and one more run reads no pixel. A block counts as landed
    once its entry is written, after its rows; until then it is made anew and
    replaced. A block whose zones have changed is made anew. Use a new path for
    other pixels, months or options.
    """
    data, entries = f"{path}/{fixed.NIGHT_LIGHT_PREFIX}blocks", f"{path}/landed"
    entry = "block int, zones bigint, print bigint"
    spark.createDataFrame([], entry).write.mode("ignore").parquet(entries)
    blocked = cut_lineage(zone_blocks(zones, blocks, zone_id))
    pending = sorted(pending_blocks(blocked, spark.read.schema(entry).parquet(entries), zone_id).collect())  # ``blocks`` rows at most
    for first in range(0, len(pending), at_once):
        turn = pending[first : first + at_once]
        some = blocked.where(F.col("block").isin([r["block"] for r in turn]))
        stats = night_light_history(pixels, some, months, zone_id, **options)
        if "block" not in stats.columns:
            stats = stats.join(some.select(zone_id, "block"), zone_id)
        stats.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("block").parquet(data)
        spark.createDataFrame(turn, entry).coalesce(1).write.mode("append").parquet(entries)
    if not pending and blocked.isEmpty():
        return night_light_history(pixels, zones, months, zone_id, **options)
    return spark.read.parquet(data).drop("block")


def product_catalogue(
    items: DataFrame,
    theme: str | None,
    collection: str,
    start: date,
    end: date,
    closed: str = "both",
    aoi_rings: str | None = None,
    aoi_wkt: str | DataFrame | None = None,
    max_cloud: int | None = None,
    tile: str | None = None,
    exclude: str | None = None,
    top: int | None = None,
    max_pages: int = 1,
) -> DataFrame:
    """Products of a collection by time, area (a polygon text, or a table of areas), name and cloud.

    All of them, in no order, unless ``top`` asks for a page set: then the
    latest ``top * max_pages``; :func:`matched_and_returned` tells how many that
    leaves out. With a ``theme`` the columns of that collection, without one all
    fields flat.
    """
    found = _matching(items, collection, start, end, closed, aoi_rings, aoi_wkt, max_cloud, tile, exclude)
    if top is not None:
        found = page(found, [F.desc("_start"), F.asc("Id")], top, max_pages)
    found = found.drop("_start")
    return product_columns(found, theme) if theme else flat_products(found)


def catalogue_run(
    spark: SparkSession, items: DataFrame, theme: str, collection: str, start: date, end: date, base: str, name: str,
    top: int | None = None, max_pages: int = 1, fmt: str = "parquet", **filters,
) -> DataFrame:
    """Write a product catalogue by theme; one row: products matched, products returned, path.

    Both counts come out of the write itself: rows are counted as they pass the
    filters, and again as they pass the page, in the one scan that is made.
    """
    matched, returned = Observation(), Observation()
    found = _matching(items, collection, start, end, **{"closed": "both", "aoi_rings": None, "aoi_wkt": None, "max_cloud": None, "tile": None, "exclude": None} | filters)
    found = found.observe(matched, F.count(F.lit(1)).alias("rows"))
    if top is not None:
        found = page(found, [F.desc("_start"), F.asc("Id")], top, max_pages)
    written = product_columns(found.drop("_start"), theme).observe(returned, F.count(F.lit(1)).alias("rows"))
    path = save_theme(written, "satelital", name, base, fmt)
    return spark.createDataFrame([(matched.get["rows"], returned.get["rows"], path)], "total bigint, returned bigint, path string")


def matched_and_returned(
    items: DataFrame, collection: str, start: date, end: date, closed: str = "both", aoi_rings: str | None = None,
    aoi_wkt: str | DataFrame | None = None, max_cloud: int | None = None, tile: str | None = None, exclude: str | None = None,
    top: int | None = None, max_pages: int = 1,
) -> DataFrame:
    """How many products :func:`product_catalogue` matches, and how many its page set returns; one row."""
    found = _matching(items, collection, start, end, closed, aoi_rings, aoi_wkt, max_cloud, tile, exclude)
    return counts(found, top, max_pages)


def _matching(
    items: DataFrame, collection: str, start: date, end: date, closed: str, aoi_rings: str | None, aoi_wkt: str | DataFrame | None,
    max_cloud: int | None, tile: str | None, exclude: str | None,
) -> DataFrame:
    found = in_window(
        items.withColumn("_start", F.col("ContentDate.Start").try_cast("timestamp")),
        collection, start, end, closed, start_col="_start",
    )
    found = name_filter(found, tile, exclude)
    found = any_attribute_le(found, max_cloud)
    if aoi_wkt is not None:
        found = intersects_aoi(found, aoi_rings, aoi_wkt)
    return found


def rail_stations(elements: DataFrame, wkt: str) -> DataFrame:
    """Stations inside the box of a polygon."""
    box = box_of(rings_of(elements.sparkSession, wkt))
    placed = tagged(elements).select(
        F.col("id").alias("osm_id"),
        F.try_element_at("tags", F.lit("name")).alias("name"),
        center_or_point("lat", "center.lat").alias("lat"),
        center_or_point("lon", "center.lon").alias("lon"),
        json_text("tags", empty_as_null=False).alias("tags"),
    )
    return in_bbox(placed, "lat", "lon", box)


def provincial_population(
    cells: DataFrame,
    dims: dict[str, DataFrame],
    order: tuple[str, str] = ("time", "geo"),
    country: str = "ES",
    length: int | None = None,
    strict: bool = False,
) -> DataFrame:
    """Population by region code and year out of a statistics cube.

    Cells past the axes fail the job with ``strict``; otherwise they are left
    out here and listed by ``cube_out_of_range``.
    """
    # The country is known before the cells are joined to it.
    dims = {**dims, order[1]: prefix(dims[order[1]], f"{order[1]}_code", country, length)}
    return _regions(decode_cube(cells, dims, order, strict=strict), order)


def provincial_population_of(
    docs: DataFrame, order: tuple[str, str] = ("time", "geo"), country: str = "ES", length: int | None = None, strict: bool = False, text: str = "text",
    doc: str = "doc",
) -> DataFrame:
    """:func:`provincial_population` straight from cube documents: one scan, no join."""
    return _regions(prefix(decode_documents(docs, order, text, doc, strict), f"{order[1]}_code", country, length), order)


def _regions(cells: DataFrame, order: tuple[str, str]) -> DataFrame:
    time_dim, geo_dim = order
    return cells.select(
        F.col(f"{geo_dim}_code").alias("region_code"),
        F.col(f"{geo_dim}_label").alias("region_name"),
        F.col(f"{time_dim}_code").cast("int").alias("year"),
        F.col("value").alias("population"),
    )


def municipal_series(entities: DataFrame, years: int | None = None) -> DataFrame:
    """Population per municipality and year; the last ``years`` periods of each entity if a number is given.

    The periods are counted inside each entity, before those without a value
    drop out, so entities without name and codes stay apart and no row moves.
    """
    return explode_series(entities if years is None else last_periods(entities, years))


def weather_repair(
    store: DataFrame,
    responses: DataFrame,
    places: DataFrame,
    today: date,
    place: list[str],
    order_col: str,
    days_back: int = fixed.WEATHER_DAYS_BACK,
    zone: str = fixed.WEATHER_ZONE,
    values: dict[str, str] = fixed.WEATHER_VALUES,
) -> tuple[DataFrame, DataFrame]:
    """Fill the missing or incomplete days of the last ``days_back`` days.

    ``places`` has one row per place (columns ``place``, which may be empty for
    a single one). Returns the rows to upsert and the store after the upsert.
    Only the store's last days are read for it and rewritten, which a store
    partitioned by day finds without opening the others; those pass untouched.
    """
    on = [*place, "date"]
    days = trailing_days(today, days_back)
    targets = places.select(*place, F.explode(days).alias("date"))
    first, last = today - timedelta(days=days_back), today - timedelta(days=1)
    recent = store.where(F.col("date").between(first, last))
    others = store.where(~F.coalesce(F.col("date").between(first, last), F.lit(False)))
    missing = needs_refresh(targets, recent, on, values)
    fetched = expand_daily(responses, list(values), zone)
    rows = complete(restrict(fetched, missing, on), values).select(*on, *values, order_col)
    return rows, others.unionByName(upsert(recent, rows, on, order_col))


def asset_run(
    products: DataFrame,
    members: DataFrame,
    done: DataFrame,
    mode: str,
    bands: list[str] | None = None,
    collection: str = fixed.SENTINEL_2,
    max_products: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Members to take from the archives of the pending products, and a status per product.

    Products already done are passed over. ``max_products`` limits a run to the
    next ones, in product order; run again for the rest.
    """
    batch = products.join(done.select("product_id"), "product_id", "left_anti")
    if max_products is not None:
        # chosen once for members and statuses
        batch = cut_lineage(page(batch, [F.desc("content_start"), F.asc("product_id")], max_products))
    patterns = asset_patterns(mode, bands, collection)
    assets = select_assets(members.join(batch.select("product_id"), "product_id", "left_semi"), patterns)
    found = assets.groupBy("product_id").agg(F.count(F.lit(1)).alias("assets"))
    name = identifier("Name", "product_id")
    status = (
        F.when(F.col("product_id").isNull(), fixed.STATUS_NO_ID)
        .when(F.col("assets") > 0, fixed.STATUS_OK)
        .otherwise(F.concat_ws(": ", name, F.lit(fixed.STATUS_NO_MATCH)))
    )
    statuses = batch.join(found, "product_id", "left").select(
        "product_id", name.alias("identifier"), status.alias("status"),
        F.coalesce("assets", F.lit(0)).cast("bigint").alias("assets"),
    )
    return assets, statuses


@dataclass(frozen=True)
class Dataset:
    """One themed output: ``build`` makes its DataFrame."""

    theme: str
    name: str
    build: Callable[[], DataFrame | None]


def first_line(failure: Exception) -> str:
    return next(iter(str(failure).strip().splitlines()), "")


RUN_SCHEMA = "theme string, dataset string, rows bigint, status string, path string"


def run_all(spark: SparkSession, datasets: list[Dataset], base: str, fmt: str = "csv", at_once: int = 4) -> DataFrame:
    """Write every dataset; one that fails is reported with its message and does not stop the rest.

    Up to ``at_once`` datasets are written side by side, so that small ones fill
    the cores a large one leaves idle. Rows are counted while they are written,
    not in a second run.
    """

    def write(d: Dataset) -> tuple:
        try:
            df = d.build()
            if df is None:
                return d.theme, d.name, 0, "empty", None
            seen = Observation()
            path = save_theme(df.observe(seen, F.count(F.lit(1)).alias("rows")), d.theme, d.name, base, fmt)
            rows = seen.get["rows"]
            return d.theme, d.name, rows, "ok" if rows else "empty", path
        except Exception as failure:  # isolation: report, go on
            return d.theme, d.name, 0, f"failed: {type(failure).__name__}: {first_line(failure)}", None

    with ThreadPool(at_once) as pool:
        return spark.createDataFrame(pool.map(inheritable_thread_target(spark)(write), datasets, chunksize=1), RUN_SCHEMA)
