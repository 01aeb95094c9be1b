"""CSV and JSON tables, keyed tables, weather, the themed run."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..fixed_values import THEME_DIRS, WEATHER_VALUES, WEATHER_ZONE
from ..functions import day_label, instant, local_date, month_label
from ..operators import (
    complete, expand_daily, join, month_spine, needs_refresh, restrict, trailing_days, upsert,
)
from ..session import scratch
from ..sinks import ensure_table, read_table, save_theme, save_theme_json, upsert_table
from ..sources import features_to_zones, read_csv, read_csv_set
from . import inputs
from .jobs import (
    Dataset, clean_night_lights, clean_population, municipal_series, night_light_history, product_catalogue,
    provincial_population_of, rail_stations, run_all, weather_repair,
)
from .queries_population import CUBE_SQL, SERIES_SQL
from .registry import query, table


# --- CSV and JSON

@query("SELECT p_partkey, p_name, p_brand, p_type, nullif(p_size, 7) AS p_size, p_retailprice FROM part")
def csv_scan(spark, sf_dir):
    """Missing cells as empty text and as ``NaN``; the columns of the schema in another order."""
    part = table(spark, sf_dir, "part").withColumn(
        "p_size", F.when(F.col("p_size") != 7, F.col("p_size").cast("string")).when(F.col("p_partkey") % 2 == 0, "NaN")
    )
    path = save_theme(part, "demografia", "part.csv", scratch(spark, "csv"))
    return read_csv(
        spark, path, "p_size int, p_retailprice double, p_partkey bigint, p_name string, p_brand string, p_type string"
    )


@query("SELECT p_partkey, p_name, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part")
def csv_scan_inferred(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    return read_csv(spark, save_theme(part, "demografia", "part.csv", scratch(spark, "csv")))


@query(
    """
SELECT event_id, user_id, value, CASE WHEN event_id % 2 = 1 THEN event_type END AS extra FROM events"""
)
def csv_set_by_name(spark, sf_dir):
    """Two file groups with other column orders, one with a column more."""
    events = table(spark, sf_dir, "events")
    base = scratch(spark, "csv-set")
    first = events.where("event_id % 2 = 0").select("event_id", "user_id", "value")
    second = events.where("event_id % 2 = 1").select("value", F.col("event_type").alias("extra"), "user_id", "event_id")
    save_theme(first, "luz_nocturna", "a", base)
    save_theme(second, "luz_nocturna", "b", base)
    return read_csv_set(
        spark, f"{base}/luz_nocturna/*", "part-", "event_id bigint, user_id bigint, value double, extra string"
    )


_PROFILE = """
SELECT c_custkey, ' "' || c_name || '", ñ ' AS c_name,
       CAST(json_object('segment', c_mktsegment, 'nation', CAST(c_nationkey AS VARCHAR)) AS VARCHAR) AS profile
FROM customer"""


def _profiles(spark, sf_dir):
    """Quotes, commas and outer spaces in the text, and a nested column."""
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit(' "'), "c_name", F.lit('", ñ ')).alias("c_name"),
        F.create_map(
            F.lit("segment"), F.col("c_mktsegment"), F.lit("nation"), F.col("c_nationkey").cast("string")
        ).alias("profile"),
    )


@query(_PROFILE)
def themed_csv(spark, sf_dir):
    path = save_theme(_profiles(spark, sf_dir), "transporte", "profiles.csv", scratch(spark, "theme"))
    return read_csv(spark, path, "c_custkey bigint, c_name string, profile string")


@query(_PROFILE)
def themed_json(spark, sf_dir):
    path = save_theme_json(_profiles(spark, sf_dir), "transporte", "profiles.json", scratch(spark, "theme"))
    landed = spark.read.schema("c_custkey bigint, c_name string, profile map<string,string>").json(path)
    return landed.withColumn("profile", F.to_json("profile"))


# --- joins

@query("SELECT doc_id, n_chars, CAST(quality AS DOUBLE) AS quality FROM documents LEFT JOIN labels USING (doc_id)")
def left_join_labels(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("quality"))
    return join(documents, labels, ["doc_id"])


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)")
def restricted_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_suppkey")
    debtors = table(spark, sf_dir, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return restrict(lines, debtors, ["l_suppkey"]).drop("l_suppkey")


_STORE_ROWS = """
daily AS (
    SELECT user_id, CAST(ts AS DATE) AS date, max(value) AS tmax, min(value) AS tmin,
           CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) AS precipitation_sum,
           CAST(count(*) AS INTEGER) AS weather_code
    FROM events GROUP BY ALL
), store AS (
    SELECT user_id, date, tmax, CASE WHEN day(date) % 5 <> 0 THEN tmin END AS tmin, precipitation_sum, weather_code
    FROM daily WHERE day(date) % 3 <> 0
)"""


@query("WITH " + _STORE_ROWS + " SELECT user_id, strftime(date, '%Y-%m-%d') AS date, tmax, tmin, weather_code FROM store WHERE tmin IS NOT NULL")
def complete_rows(spark, sf_dir):
    """Null, NaN and text that is no number drop the row."""
    day = F.dayofmonth("date")
    dirty = inputs.weather_store(spark, sf_dir).withColumns({
        "tmin": F.when(day % 10 == 5, F.lit(float("nan"))).otherwise(F.col("tmin")),
        "weather_code": F.when(day % 10 == 0, F.lit("n/a")).otherwise(F.col("weather_code").cast("string")),
    })
    kept = complete(dirty, {"tmax": "double", "tmin": "double", "weather_code": "int"})
    return kept.select("user_id", day_label("date").alias("date"), "tmax", "tmin", "weather_code")


@query(
    "WITH " + _STORE_ROWS + """
SELECT u.user_id, strftime(d.date, '%Y-%m-%d') AS date
FROM (SELECT DISTINCT user_id FROM events) u
CROSS JOIN (SELECT CAST(unnest(generate_series(TIMESTAMP '2024-01-22', TIMESTAMP '2024-01-28', INTERVAL 1 DAY)) AS DATE) AS date) d
ANTI JOIN (SELECT * FROM store WHERE tmin IS NOT NULL) s ON s.user_id = u.user_id AND s.date = d.date"""
)
def days_to_refresh(spark, sf_dir):
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    targets = users.select("user_id", F.explode(trailing_days(inputs.WEATHER_TODAY)).alias("date"))
    missing = needs_refresh(targets, inputs.weather_store(spark, sf_dir), ["user_id", "date"], WEATHER_VALUES)
    return missing.select("user_id", day_label("date").alias("date"))


# --- upsert

_CHANGES = """
changes AS (
    SELECT CASE WHEN l_partkey % 3 = 0 THEN -l_orderkey ELSE l_orderkey END AS o_orderkey, 'L' || arg_max(l_returnflag, n) AS status, arg_max(cents, n) AS cents
    FROM (SELECT *, cents * 1000 + ascii(l_returnflag) AS n
          FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem))
    GROUP BY 1
), base AS (
    SELECT o_orderkey, o_orderstatus AS status, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
           CAST(extract(year FROM o_orderdate) AS INTEGER) AS year
    FROM orders
)"""


def _orders_base(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_orderstatus").alias("status"), inputs.cents("o_totalprice").alias("cents"),
        F.year("o_orderdate").alias("year"),
    )


def _line_changes(spark, sf_dir):
    """Several changes per order, the highest price wins; a third go to keys that are new."""
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_partkey") % 3 == 0, -F.col("l_orderkey")).otherwise(F.col("l_orderkey")).alias("o_orderkey"),
        F.concat(F.lit("L"), "l_returnflag").alias("status"),
        inputs.cents("l_extendedprice").alias("cents"),
        (inputs.cents("l_extendedprice") * 1000 + F.ascii("l_returnflag")).alias("n"),
    )


@query(
    "WITH " + _CHANGES + """
SELECT o_orderkey, status, cents FROM base ANTI JOIN changes USING (o_orderkey)
UNION ALL SELECT o_orderkey, status, cents FROM changes"""
)
def keyed_upsert(spark, sf_dir):
    base = _orders_base(spark, sf_dir).drop("year")
    return upsert(base, _line_changes(spark, sf_dir), ["o_orderkey"], "n")


@query(
    "WITH " + _CHANGES + """
, latest AS (
    SELECT o_orderkey, c.status, c.cents, b.year FROM changes c JOIN base b USING (o_orderkey) WHERE b.year >= 1999
)
SELECT * FROM base ANTI JOIN latest USING (o_orderkey) UNION ALL SELECT * FROM latest"""
)
def keyed_table_upsert(spark, sf_dir):
    """A stored table by year: created once, filled, then changed in place in its last years."""
    schema = "o_orderkey bigint, status string, cents bigint, year int"
    path = scratch(spark, "keyed")
    ensure_table(spark, path, schema, "year")
    base = _orders_base(spark, sf_dir)
    upsert_table(spark, path, schema, base.withColumn("n", F.lit(0)), ["o_orderkey", "year"], "n", "year")
    ensure_table(spark, path, schema, "year")
    changes = _line_changes(spark, sf_dir).join(
        base.where("year >= 1999").select("o_orderkey", "year"), "o_orderkey"
    )
    upsert_table(spark, path, schema, changes, ["o_orderkey", "year"], "n", "year")
    return read_table(spark, path, schema)


# --- calendar and weather

@query(
    """
SELECT strftime(m, '%Y-%m') AS month, coalesce(n, 0) AS orders
FROM (SELECT unnest(generate_series(date_trunc('year', min(o_orderdate)), date_trunc('year', max(o_orderdate)) + INTERVAL 11 MONTH, INTERVAL 1 MONTH)) AS m FROM orders)
LEFT JOIN (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1) USING (m)"""
)
def orders_by_month(spark, sf_dir):
    """All months of the years that have orders; one without orders keeps its row."""
    monthly = (
        table(spark, sf_dir, "orders")
        .groupBy(F.trunc("o_orderdate", "month").alias("_day")).agg(F.count(F.lit(1)).alias("n"))
    )
    first, last = table(spark, sf_dir, "orders").agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    if first is None:
        return monthly.select(month_label("_day").alias("month"), F.col("n").alias("orders"))
    spine = spark.range(1).select(F.explode(month_spine(first, last)).alias("_day"))
    return spine.join(monthly, "_day", "left").select(
        month_label("_day").alias("month"), F.coalesce("n", F.lit(0)).cast("bigint").alias("orders")
    )


@query(
    """
SELECT event_id, strftime(ts, '%Y-%m') AS month, strftime(ts, '%Y-%m-%d') AS day,
       epoch_ms(date_trunc('second', ts)) // 1000 AS seconds,
       strftime(ts + INTERVAL 1 HOUR, '%Y-%m-%d') AS local_day
FROM events"""
)
def time_labels(spark, sf_dir):
    """ISO text to an instant, labels, and the day in Madrid (winter: one hour ahead)."""
    events = table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("text")
    )
    at = instant("text")
    return events.select(
        "event_id", month_label(at).alias("month"), day_label(at).alias("day"),
        F.unix_timestamp(at).alias("seconds"),
        day_label(local_date(F.unix_timestamp(at), WEATHER_ZONE)).alias("local_day"),
    )


@query(
    """
WITH days AS (
    SELECT o_custkey, CAST(unnest(generate_series(max(o_orderdate) - INTERVAL 7 DAY, max(o_orderdate) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS day
    FROM orders GROUP BY o_custkey
)
SELECT o_custkey, strftime(day, '%Y-%m-%d') AS day FROM days"""
)
def trailing_days_by_customer(spark, sf_dir):
    """The seven days before each customer's last order."""
    last = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max("o_orderdate").cast("date").alias("last"))
    return last.select("o_custkey", F.explode(trailing_days(F.col("last"), 7)).alias("day")).withColumn(
        "day", day_label("day")
    )


@query(
    "WITH " + _STORE_ROWS + """
SELECT user_id, strftime(d.date, '%Y-%m-%d') AS date, tmax, tmin, precipitation_sum, CAST(weather_code AS DOUBLE) AS weather_code
FROM (SELECT DISTINCT user_id FROM daily) u
CROSS JOIN (SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM daily) d
LEFT JOIN daily USING (user_id, date)"""
)
def daily_expansion(spark, sf_dir):
    rows = expand_daily(inputs.weather_responses(spark, sf_dir), list(WEATHER_VALUES), WEATHER_ZONE)
    return rows.drop("batch").withColumn("date", day_label("date"))


_REPAIRED = """
repaired AS (
    SELECT * FROM daily
    WHERE date BETWEEN DATE '2024-01-22' AND DATE '2024-01-28' AND (day(date) % 3 = 0 OR day(date) % 5 = 0)
)"""


def _repair(spark, sf_dir):
    """Store by day and responses as they are landed; one row per place."""
    store, responses = scratch(spark, "store"), scratch(spark, "responses")
    inputs.weather_store(spark, sf_dir).write.partitionBy("date").parquet(store)
    inputs.weather_responses(spark, sf_dir).write.parquet(responses)
    responses = spark.read.parquet(responses)
    return weather_repair(
        spark.read.parquet(store), responses, responses.select("user_id"), inputs.WEATHER_TODAY, ["user_id"], "batch",
    )


@query(
    "WITH " + _STORE_ROWS + "," + _REPAIRED + """
SELECT user_id, strftime(date, '%Y-%m-%d') AS date, tmax, tmin, precipitation_sum, weather_code FROM (
    SELECT * FROM store ANTI JOIN repaired USING (user_id, date) UNION ALL SELECT * FROM repaired)"""
)
def weather_repaired(spark, sf_dir):
    return _repair(spark, sf_dir)[1].withColumn("date", day_label("date"))


@query(
    "WITH " + _STORE_ROWS + "," + _REPAIRED + """
SELECT strftime(date, '%Y-%m-%d') AS date, count(*) AS rows FROM repaired GROUP BY 1"""
)
def weather_rows_upserted(spark, sf_dir):
    rows, _ = _repair(spark, sf_dir)
    return rows.groupBy(day_label("date").alias("date")).agg(F.count(F.lit(1)).alias("rows"))


# --- the themed run

@query(
    "WITH " + CUBE_SQL + "," + SERIES_SQL + """
SELECT 'demografia' AS theme, 'poblacion' AS dataset, count(*) AS rows, 'ok' AS status FROM (
    SELECT DISTINCT user_id, extract(day FROM ts) FROM events WHERE event_type IN ('view', 'click', 'purchase'))
UNION ALL SELECT 'luz_nocturna', 'luces', count(DISTINCT strftime(l_shipdate, '%Y-%m')), 'ok' FROM lineitem
UNION ALL SELECT 'satelital', 'sentinel1', count(*), 'ok' FROM orders
    WHERE o_orderstatus = 'P' AND o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1999-07-01'
UNION ALL SELECT 'satelital', 'sentinel2', count(*), 'ok' FROM orders
    WHERE o_orderstatus <> 'P' AND o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1999-07-01'
UNION ALL SELECT 'demografia', 'provincias', count(*), 'ok' FROM cube WHERE in_range AND code LIKE 'ES%'
UNION ALL SELECT 'demografia', 'municipios', count(*), 'ok' FROM series
UNION ALL SELECT 'luz_nocturna', 'historia', count(*) * 24, 'ok' FROM supplier
UNION ALL SELECT 'transporte', 'estaciones', count(*), 'ok' FROM customer
    WHERE (c_mktsegment IN ('BUILDING', 'MACHINERY') OR (c_mktsegment = 'HOUSEHOLD' AND c_custkey % 3 = 0))
      AND c_custkey % 100 <> 3 AND 34.0 + (c_custkey * 37 % 1280) * 0.0078125 BETWEEN 36.0 AND 43.8
      AND -11.0 + (c_custkey * 53 % 2048) * 0.0078125 BETWEEN -9.5 AND 3.3
UNION ALL SELECT 'otro', 'estaciones', 0, 'failed: ValueError: unknown theme ''otro''; known: """ + ", ".join(THEME_DIRS) + """'
UNION ALL SELECT 'transporte', 'nada', count(*) * 0, 'empty' FROM customer"""
)
def themed_run(spark, sf_dir):
    """All datasets of a run, one with an unknown theme and one without rows."""
    from ..fixed_values import AOIS

    def stations():
        return rail_stations(inputs.map_elements(spark, sf_dir), AOIS["peninsula"])

    datasets = [
        Dataset("demografia", "poblacion", lambda: clean_population(
            inputs.population_titles(spark, sf_dir), inputs.user_provinces(spark, sf_dir),
            inputs.EVENT_CATEGORIES, inputs.EVENT_COLUMNS,
        )),
        Dataset("luz_nocturna", "luces", lambda: clean_night_lights(
            inputs.night_light_rows(spark, sf_dir), "row_order", keys=["date"],
        )),
        Dataset("satelital", "sentinel1", lambda: product_catalogue(
            inputs.catalogue_items(spark, sf_dir), "sentinel1", "SENTINEL-1", date(1996, 3, 1), date(1999, 6, 30),
        )),
        Dataset("satelital", "sentinel2", lambda: product_catalogue(
            inputs.catalogue_items(spark, sf_dir), "sentinel2", "SENTINEL-2", date(1996, 3, 1), date(1999, 6, 30),
        )),
        Dataset("demografia", "provincias", lambda: provincial_population_of(inputs.cube_documents(spark, sf_dir), inputs.CUBE_ORDER)),
        Dataset("demografia", "municipios", lambda: municipal_series(inputs.municipal_entities(spark, sf_dir))),
        Dataset("luz_nocturna", "historia", lambda: night_light_history(
            inputs.pixels(spark, sf_dir), features_to_zones(inputs.zone_features(spark, sf_dir), inputs.ZONE_PROPERTIES),
            month_spine(1997, 1998),
        )),
        Dataset("otro", "estaciones", stations),
        Dataset("transporte", "estaciones", stations),
        Dataset("transporte", "nada", lambda: stations().where("lat < 0")),
    ]
    return run_all(spark, datasets, scratch(spark, "run")).drop("path")
