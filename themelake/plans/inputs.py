"""The reference's inputs, derived by Spark from the given tables.

The tables hold no catalogue, map, cube or weather data, so each input is a
projection of one of them in the landed form, and grows with it. Coordinates
are multiples of a power of two, money is whole cents: sums and comparisons are
then exact in every engine.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import WEATHER_ZONE
from ..operators import computed_once
from .registry import table


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


# --- population -----------------------------------------------------------

EVENT_CATEGORIES = ["View", "Click", "Purchase"]
EVENT_COLUMNS = {"View": "vistas", "Click": "clics", "Purchase": "compras"}


def population_titles(spark: SparkSession, sf_dir: str, spellings: int = 1) -> DataFrame:
    """Series titles such as ``Úser 8. View. Dato``; every other one plain if there are two spellings."""
    events = table(spark, sf_dir, "events")
    name = F.when(F.col("event_id") % spellings == 0, F.lit("Úser ")).otherwise(F.lit("User "))
    return events.select(
        F.concat(name, "user_id", F.lit(". "), F.initcap("event_type"), F.lit(". Dato")).alias("municipio"),
        F.dayofmonth("ts").alias("year"),
        cents("value").alias("population"),
    )


def user_provinces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("Úser "), "n_nationkey").alias("municipio"), F.col("n_name").alias("provincia")
    )


def municipal_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entity per customer, its yearly order value nested; some names, codes and values (newest years too) absent."""
    orders = table(spark, sf_dir, "orders")
    yearly = orders.groupBy("o_custkey", F.year("o_orderdate").alias("Anyo")).agg(
        F.sum(cents("o_totalprice")).cast("double").alias("Valor")
    )
    value = F.when(F.col("Anyo") % 4 != 0, F.col("Valor"))
    data = yearly.groupBy("o_custkey").agg(  # one element per year
        F.collect_list(F.struct("Anyo", value.alias("Valor"))).alias("Data")
    )
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").join(data, k == F.col("o_custkey"), "left").select(
        F.when(k % 7 != 0, F.col("c_name")).alias("Nombre"),
        F.when(k % 5 != 0, F.col("c_nationkey").cast("string")).alias("CODPROV"),
        F.when(k % 35 != 0, k.cast("string")).alias("CODMUNI"),  # each 35th has neither name nor codes
        "Data",
    )


# --- statistics cube ------------------------------------------------------

CUBE_ORDER = ("time", "geo")


def cube_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cube per order priority: orders by nation and year, as JSON text.

    Nations are listed from the last to the first, so text order is not sorted
    order. In the first cube the cells of nation 24 are shifted past the axis.
    Orders are counted first; a document then holds one cell per nation and year.
    """
    nation, customer, orders = (table(spark, sf_dir, t) for t in ("nation", "customer", "orders"))
    country = F.when(F.col("n_regionkey") < 3, F.lit("ES")).otherwise(F.lit("FR"))
    counted = (
        orders.select("o_custkey", "o_orderpriority", F.year("o_orderdate").alias("year"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("o_orderpriority", "year", "c_nationkey")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("code", F.concat(country, F.col("n_nationkey") + 100))
    )
    axes = counted.groupBy("o_orderpriority").agg(
        F.sort_array(F.collect_set(F.struct(-F.col("n_nationkey"), "code", "n_name"))).alias("geo"),
        F.sort_array(F.collect_set("year")).alias("years"),
        F.collect_list(F.struct("year", "code", "n_nationkey", "n")).alias("cells"),
    )
    codes = F.transform("geo", lambda g: g["code"])

    def cell(c: Column) -> Column:
        year_pos = F.array_position("years", c["year"]) - 1
        shifted = F.when(
            (F.col("o_orderpriority") == "1-URGENT") & (c["n_nationkey"] == 24), F.size("years")
        ).otherwise(0)
        flat = (year_pos + shifted) * F.size("geo") + F.array_position(codes, c["code"]) - 1
        return F.struct(flat.cast("string"), c["n"])

    cells = axes.select(
        "o_orderpriority",
        F.map_from_entries(F.transform("cells", cell)).alias("value"),
        F.map_from_arrays(codes, F.transform("geo", lambda g: g["n_name"])).alias("geo"),
        F.transform("years", lambda y: y.cast("string")).alias("years"),
    )
    labels = F.map_from_arrays("years", "years")

    def dimension(label: Column) -> Column:
        return F.struct(F.struct(label.alias("label")).alias("category"))

    return cells.select(
        F.col("o_orderpriority").alias("doc"),
        F.to_json(
            F.struct(
                F.struct(dimension(F.col("geo")).alias("geo"), dimension(labels).alias("time")).alias("dimension"),
                "value",
            )
        ).alias("text"),
    )


# --- product catalogue ----------------------------------------------------

def content_start() -> Column:
    """Order day plus a time of day; both ends of the day occur."""
    k = F.col("o_orderkey")
    ms = F.when(k % 50 == 0, 0).when(k % 50 == 1, 86399999).otherwise((k * 7919) % 86400 * 1000)
    return F.col("o_orderdate") + F.make_dt_interval(secs=(ms / 1000).cast("decimal(18,6)"))


def iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def catalogue_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One product per order, in the nested form of the catalogue."""
    k = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    stem = (
        F.when(status == "F", F.lit("S2A_MSIL2A_"))
        .when(status == "O", F.lit("S2B_MSIL1C_"))
        .otherwise(F.lit("S1A_IW_GRDH_"))
    )
    name = F.concat(
        stem, F.lit("T"), (k % 60).cast("string"), F.lit("ABC_"), k.cast("string"),
        F.when(k % 11 == 0, F.lit("")).otherwise(F.lit(".SAFE")),
    )
    west, south = F.col("_west"), F.col("_south")
    placed = computed_once(
        table(spark, sf_dir, "orders"),
        _west=F.lit(-12.0) + (k * 37 % 1024) * F.lit(0.015625), _south=F.lit(34.0) + (k * 53 % 768) * F.lit(0.015625),
    )

    def triangle(dx: float, dy: float) -> Column:
        x, y = west + dx, south + dy
        return F.array(F.array(x, y), F.array(x + 1, y), F.array(x, y + 1), F.array(x, y))

    # every seventh product has two parts
    two_parts = k % 7 == 0
    coordinates = F.when(two_parts, F.to_json(F.array(F.array(triangle(0, 0)), F.array(triangle(3, 2))))).otherwise(F.to_json(F.array(triangle(0, 0))))

    def attribute(name_: Column, field: str, value: Column) -> Column:
        return F.create_map(F.lit("Name"), name_, F.lit(field), value.cast("string"))

    cloud_name = F.when(k % 2 == 0, F.lit("CloudCover")).otherwise(F.lit("cloudCoverMean"))
    first_cloud = F.when(
        k % 5 == 0, attribute(cloud_name, "doubleValue", k % 90 + F.lit(0.5))
    ).otherwise(attribute(cloud_name, "Value", k % 100))
    start = content_start()
    return placed.select(
        F.concat(F.lit("P"), k).alias("Id"),
        F.when(k % 97 != 0, name).alias("Name"),
        F.struct(iso(start).alias("Start"), iso(start + F.expr("interval 1 day")).alias("End")).alias("ContentDate"),
        iso(F.col("o_orderdate")).alias("IngestionDate"),
        cents("o_totalprice").alias("sizeInBytes"),
        F.struct(
            F.when(two_parts, F.lit("MultiPolygon")).otherwise(F.lit("Polygon")).alias("type"), coordinates.alias("coordinates"),
        ).alias("GeoFootprint"),
        F.when(k % 3 != 0, (k % 101).cast("double")).alias("CloudCover"),
        F.array(
            attribute(F.lit("orbitNumber"), "Value", k),
            first_cloud,
            attribute(F.lit("cloudShadow"), "Value", F.lit(77)),
            attribute(F.lit("polarisationChannels"), "stringValue", F.when(k % 2 == 0, F.lit("VV")).otherwise(F.lit("VV&VH"))),
        ).alias("Attributes"),
        F.when(
            k % 4 != 0,
            F.array(F.create_map(F.lit("Type"), F.lit("S3"), F.lit("S3Path"), F.concat(F.lit("/archive/ñ/"), k))),
        ).alias("Assets"),
        F.when(status == "P", F.lit("SENTINEL-1")).otherwise(F.lit("SENTINEL-2")).alias("collection"),
    )


def paged(df: DataFrame, number: Column, items: str) -> DataFrame:
    """Rows packed into API pages; ``number`` spreads them, a page stays small."""
    return df.groupBy(number.alias("_page")).agg(F.collect_list(F.struct(*df.columns)).alias(items)).drop("_page")


def bare_coordinates(json: Column) -> Column:
    """JSON text with coordinates that are text written as the arrays they are."""
    return F.regexp_replace(json, r'"coordinates":"([^"]*)"', r'"coordinates":$1')


def catalogue_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of 500 products as JSON text; some products have fields that no schema lists, one of them nested."""
    k = F.substring("Id", 2, 18).cast("bigint")
    items = catalogue_items(spark, sf_dir).withColumns({
        "EvictionDate": F.when(k % 13 == 0, F.col("IngestionDate")),
        "Quality": F.when(k % 3 == 0, F.struct(F.when(k % 2 == 0, k % 10).alias("Score"), F.lit("auto").alias("Check level"))),
    })
    pages = paged(items, F.floor(k / 500), "value")
    return pages.select(bare_coordinates(F.to_json(F.struct("value"))).alias("page"))


# --- map elements ---------------------------------------------------------

def map_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One element per customer; ways and relations have a center only."""
    k = F.col("c_custkey")
    kind = F.element_at(F.array(F.lit("node"), F.lit("way"), F.lit("relation")), (k % 3 + 1).cast("int"))
    lat = F.when(k % 100 == 3, F.lit(0.0)).otherwise(F.lit(34.0) + (k * 37 % 1280) * F.lit(0.0078125))
    lon = F.lit(-11.0) + (k * 53 % 2048) * F.lit(0.0078125)
    segment = F.col("c_mktsegment")
    tags = F.map_concat(
        F.create_map(F.lit("segment"), segment),
        F.when(segment.isin("BUILDING", "MACHINERY"), F.create_map(F.lit("railway"), F.lit("station")))
        .when(segment == "HOUSEHOLD", F.create_map(F.lit("station"), F.lit("rail")))
        .otherwise(F.create_map(F.lit("railway"), F.lit("halt"))),
        F.when(k % 10 != 0, F.create_map(F.lit("name"), F.concat(F.lit("Estación "), k)))
        .otherwise(F.create_map(F.lit("ref"), k.cast("string"))),
    )
    is_node = kind == "node"
    return table(spark, sf_dir, "customer").select(
        kind.alias("type"), k.alias("id"),
        F.when(is_node, lat).alias("lat"), F.when(is_node, lon).alias("lon"),
        F.when(~is_node, F.struct(lat.alias("lat"), lon.alias("lon"))).alias("center"),
        tags.alias("tags"),
    )


# --- night lights ---------------------------------------------------------

def night_light_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per order line, under the names of the night-light files."""
    key = F.col("l_orderkey") * 1_000_000_000 + F.col("l_linenumber") * 100_000_000 + F.col("l_suppkey")
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") != 1, F.concat(F.lit("Lugar "), F.col("l_suppkey") % 50)).alias("LAU_NAME"),
        F.date_format("l_shipdate", "yyyy-MM").alias("system_DATE"),
        F.nullif(F.col("l_quantity"), F.lit(13.0)).alias("mean"),
        cents("l_extendedprice").alias("max"),
        key.alias("row_order"),
    )


def _last_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key of the last zone, and the side of them all."""
    last = F.col("last")
    halvings = sum((F.when(last >= 1280 * 4**j, 1).otherwise(0) for j in range(1, 12)), F.when(last >= 1280, 1).otherwise(0))
    return table(spark, sf_dir, "supplier").agg(F.max("s_suppkey").alias("last")).withColumn("side", 0.25 * F.pow(F.lit(0.5), halvings))


def zone_side(spark: SparkSession, sf_dir: str) -> Column:
    """Side of a zone: a quarter of a degree for 1,280 suppliers, halved for each four times as many, so zones never overlap."""
    return _last_zone(spark, sf_dir).select("side").scalar()


def land_steps(spark: SparkSession, sf_dir: str) -> Column:
    """Steps of a 1,024th of a degree from 35.5 to half a degree past the last zone."""
    last, side = F.col("last"), F.col("side")
    north = F.lit(36.0) + F.floor(last / (10 / side).cast("bigint")) * side + side
    return _last_zone(spark, sf_dir).select(F.ceil((north - 35) * 1024)).scalar()


def pixels(spark: SparkSession, sf_dir: str, lat_steps: Column | None = None) -> DataFrame:
    """One pixel per order line, over all the land that zones may cover, or ``lat_steps`` of it; a third of them fall into one zone."""
    lat_steps = F.lit(9216) if lat_steps is None else lat_steps
    o, p, n = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    a, b = o * 37 + p * 13 + n * 101, o * 53 + p * 29 + n * 7
    hot, side = p % 3 == 0, F.col("_side")
    return table(spark, sf_dir, "lineitem").withColumn("_side", zone_side(spark, sf_dir)).select(
        F.when(hot, F.lit(-10.0) + (a % 256) / 256.0 * side).otherwise(F.lit(-10.5) + (a % 11264) / 1024.0).alias("lon"),
        F.when(hot, F.lit(36.0) + (b % 256) / 256.0 * side).otherwise(F.lit(35.5) + (b % lat_steps) / 1024.0).alias("lat"),
        F.col("l_shipdate").cast("date").alias("date"),
        F.nullif(F.col("l_quantity"), F.lit(13.0)).alias("avg_rad"),
    )


def zone_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One concave polygon per supplier, side by side; every third has a hole, every fourth is a multipolygon."""
    k, side = F.col("s_suppkey"), F.col("_side")
    columns = (10 / side).cast("bigint")
    x0, y0 = F.col("_x0"), F.col("_y0")
    placed = computed_once(
        table(spark, sf_dir, "supplier").withColumn("_side", zone_side(spark, sf_dir)),
        _x0=F.lit(-10.0) + (k % columns) * side, _y0=F.lit(36.0) + F.floor(k / columns) * side,
    )

    def ring(corners: list[tuple[float, float]]) -> Column:
        return F.array(*[F.array(x0 + side * dx, y0 + side * dy) for dx, dy in corners])

    outer = ring([(0, 0), (1, 0), (1, 1), (0.5, 0.5), (0, 1), (0, 0)])
    hole = ring([(0.375, 0.125), (0.5, 0.125), (0.5, 0.25), (0.375, 0.25), (0.375, 0.125)])
    polygon = F.when(k % 3 == 0, F.array(outer, hole)).otherwise(F.array(outer))
    multi = k % 4 == 0
    return placed.select(
        F.lit("Feature").alias("type"),
        F.create_map(
            F.lit("GISCO_ID"), F.concat(F.lit("ES_"), k), F.lit("LAU_NAME"), F.col("s_name")
        ).alias("properties"),
        F.struct(
            F.when(multi, F.lit("MultiPolygon")).otherwise(F.lit("Polygon")).alias("type"),
            F.when(multi, F.to_json(F.array(polygon))).otherwise(F.to_json(polygon)).alias("coordinates"),
        ).alias("geometry"),
    )


ZONE_PROPERTIES = {"GISCO_ID": "zone_id", "LAU_NAME": "LAU_NAME"}


# --- weather --------------------------------------------------------------

WEATHER_TODAY = date(2024, 1, 29)


def daily_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per user and day."""
    return table(spark, sf_dir, "events").groupBy(
        "user_id", F.to_date("ts").alias("date")
    ).agg(
        F.max("value").alias("tmax"),
        F.min("value").alias("tmin"),
        F.sum(cents("value")).cast("double").alias("precipitation_sum"),
        F.count(F.lit(1)).cast("int").alias("weather_code"),
    )


def weather_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: a time axis from the first to the last day of ``events`` and four parallel arrays."""
    daily = daily_weather(spark, sf_dir)
    first, last = table(spark, sf_dir, "events").agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    if first is None:
        first, last, daily = WEATHER_TODAY, WEATHER_TODAY, daily.limit(0)
    n_days = (last - first).days + 1
    midnight = lambda d: F.unix_timestamp(F.to_utc_timestamp(F.lit(d).cast("timestamp"), WEATHER_ZONE))
    day = F.date_diff("date", F.lit(first))
    by_day = daily.groupBy("user_id").agg(  # an entry a day at most
        F.map_from_entries(
            F.collect_list(
                F.struct(day, F.struct("tmax", "tmin", "precipitation_sum", F.col("weather_code").cast("double").alias("weather_code")))
            )
        ).alias("days")
    )

    def axis(field: str) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.lit(n_days - 1)), lambda d: F.try_element_at(F.col("days"), d)[field]
        ).alias(field)

    return by_day.select(
        "user_id",
        midnight(first).alias("start"),
        (midnight(first) + n_days * 86400).alias("end"),
        F.lit(86400).cast("bigint").alias("interval"),
        *[axis(f) for f in ("tmax", "tmin", "precipitation_sum", "weather_code")],
        F.lit(1).alias("batch"),
    )


def weather_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings with every third day missing and every fifth without its minimum."""
    day = F.dayofmonth("date")
    return daily_weather(spark, sf_dir).where(day % 3 != 0).withColumn(
        "tmin", F.when(day % 5 != 0, F.col("tmin"))
    )


# --- archive members ------------------------------------------------------

def archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One member path per order line, in the folders of both missions."""
    n, o = F.col("l_linenumber"), F.col("l_orderkey")
    res = F.element_at(F.array(F.lit("10"), F.lit("20"), F.lit("60")), (F.col("l_partkey") % 3 + 1).cast("int"))
    band = F.element_at(
        F.array(*[F.lit(b) for b in ("TCI", "SCL", "B04", "B08", "tci", "PREVIEW")]),
        (F.col("l_suppkey") % 6 + 1).cast("int"),
    )
    base = F.concat(F.lit("P"), o, F.lit(".SAFE/"))
    path = (
        F.when(n == 1, F.concat(base, F.lit("GRANULE/x/IMG_DATA/R"), res, F.lit("m/T_"), band, F.lit("_"), res, F.lit("m.jp2")))
        .when(n == 2, F.concat(base, F.lit("IMG_DATA_R"), res, F.lit("m/T_"), band, F.lit(".jp2")))
        .when(n == 3, F.concat(base, F.lit("measurement/iw-"), band, F.lit(".tiff")))
        .when(n == 4, F.concat(base, F.lit("manifest.safe")))
        .when(n == 5, F.concat(base, F.lit("preview/quick-look.png")))
        .otherwise(F.concat(base, F.lit("IMG_DATA/"), band, F.lit(".tiff")))
    )
    return table(spark, sf_dir, "lineitem").select(F.concat(F.lit("P"), o).alias("product_id"), path.alias("member"))
