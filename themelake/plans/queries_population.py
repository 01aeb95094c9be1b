"""Population: titles, pivots, lookups, series and cubes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixed_values import SERIES_DEFAULTS, UNKNOWN_PROVINCE
from ..functions import extract_category, head_segment, json_text, normalise
from ..operators import (
    count_distinct, distinct_sorted, latest_n, lookup, pivot_mean, prefix, unmatched,
)
from ..session import scratch
from ..sources import cube_out_of_range, decode_cube, decode_documents, explode_series, read_cube
from ..sources.cube import split_cube
from . import inputs
from .jobs import clean_population, municipal_series, provincial_population_of
from .registry import query, table

# What a strip takes off, for the trim of the SQL side.
_SPACES = "".join(
    chr(c) for c in [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
)
_FOLD = "translate(lower(trim({0}, '" + _SPACES + "')), '’áéíóúüñ', '''aeiouun')"

_TITLES = """
titles AS (
    SELECT event_id, {name} || user_id || '. ' || upper(event_type[1]) || event_type[2:] || '. Dato' AS title,
           CAST(extract(day FROM ts) AS INTEGER) AS year,
           CAST(round(value * 100) AS BIGINT) AS population
    FROM events
)"""


def _boundary_regex(words: str) -> str:
    return rf"(?:^|[^\p{{L}}\p{{M}}\p{{N}}_])({words})(?:$|[^\p{{L}}\p{{M}}\p{{N}}_])"


_CATEGORY = "nullif(regexp_extract(title, '" + _boundary_regex("View|Click|Purchase") + "', 1), '')"
_NAME = _FOLD.format("split_part(title, '.', 1)")

_WIDE = (
    "named AS (SELECT " + _NAME + " AS municipio, year, " + _CATEGORY + " AS category, population FROM titles),"
    """
wide AS (
    SELECT municipio, year,
           avg(population) FILTER (category = 'View') AS vistas,
           avg(population) FILTER (category = 'Click') AS clics,
           avg(population) FILTER (category = 'Purchase') AS compras
    FROM named WHERE category IS NOT NULL GROUP BY municipio, year
),
provinces AS (SELECT """ + _FOLD.format("'Úser ' || n_nationkey") + " AS municipio, n_name AS provincia FROM nation)"
)


@query(
    "WITH " + _TITLES.format(name="'Úser '") + ", " + _WIDE + """
SELECT w.*, coalesce(p.provincia, 'Desconocida') AS provincia
FROM wide w LEFT JOIN provinces p USING (municipio)"""
)
def population_clean(spark, sf_dir):
    return clean_population(
        inputs.population_titles(spark, sf_dir), inputs.user_provinces(spark, sf_dir),
        inputs.EVENT_CATEGORIES, inputs.EVENT_COLUMNS,
    )


@query(
    "WITH " + _TITLES.format(name="CASE WHEN event_id % 2 = 0 THEN 'Úser ' ELSE 'User ' END") + """
, wide AS (
    SELECT split_part(title, '.', 1) AS raw, year,
           avg(population) FILTER (title LIKE '%. View. %') AS vistas,
           avg(population) FILTER (title LIKE '%. Click. %') AS clics,
           avg(population) FILTER (title LIKE '%. Purchase. %') AS compras
    FROM titles WHERE title LIKE '%. View. %' OR title LIKE '%. Click. %' OR title LIKE '%. Purchase. %'
    GROUP BY ALL
)
SELECT """ + _FOLD.format("raw") + """ AS municipio, year, vistas, clics, compras,
       coalesce(n_name, 'Desconocida') AS provincia
FROM wide LEFT JOIN nation ON raw[6:] = CAST(n_nationkey AS VARCHAR)"""
)
def population_two_spellings(spark, sf_dir):
    """Normalised after the pivot: each spelling keeps a row of its own."""
    return clean_population(
        inputs.population_titles(spark, sf_dir, spellings=2), inputs.user_provinces(spark, sf_dir),
        inputs.EVENT_CATEGORIES, inputs.EVENT_COLUMNS, normalise_after=True,
    )


@query(
    """
SELECT o_custkey, CAST(extract(year FROM o_orderdate) AS INTEGER) AS year,
       avg(cents) FILTER (o_orderstatus = 'F') AS cerrado,
       avg(cents) FILTER (o_orderstatus = 'O') AS "O"
FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
WHERE o_orderstatus IN ('F', 'O') GROUP BY ALL"""
)
def pivot_means(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", F.year("o_orderdate").alias("year"), "o_orderstatus", inputs.cents("o_totalprice").alias("cents")
    )
    return pivot_mean(orders, ["o_custkey", "year"], "o_orderstatus", "cents", ["F", "O"], {"F": "cerrado"})


@query(
    "SELECT doc_id, md5(trim(split_part(text, '.', 1), '" + _SPACES + "')) AS head FROM documents"
)
def head_segments(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(head_segment("text")).alias("head"))


@query(
    "SELECT doc_id, nullif(regexp_extract(text, '"
    + _boundary_regex("there|which|queai|éaument|oder|los|una") + "', 1), '') AS category FROM documents"
)
def word_categories(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        extract_category("text", ["there", "which", "queai", "éaument", "oder", "los", "una"]).alias("category"),
    )


@query("SELECT conv_id, turn, md5(" + _FOLD.format("text") + ") AS folded FROM conversations")
def normalised_texts(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.md5(normalise("text")).alias("folded")
    )


@query(
    """
SELECT c_custkey, c_name, coalesce(s.s_name, 'Desconocida') AS supplier
FROM customer LEFT JOIN (SELECT DISTINCT s_suppkey, s_name FROM supplier) s
  ON c_custkey = s.s_suppkey + s.s_suppkey"""
)
def lookup_default(spark, sf_dir):
    """Accents and case differ between the two sides."""
    named = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.concat(F.lit("CLÍENTE "), "c_custkey").alias("name")
    )
    dictionary = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit(" clíente "), F.col("s_suppkey") * 2).alias("name"), F.col("s_name").alias("supplier")
    )
    return lookup(named, dictionary, "name", "supplier", UNKNOWN_PROVINCE).drop("name")


@query("SELECT doc_id, lang, n_chars FROM documents ANTI JOIN labels USING (doc_id)")
def lookup_unmatched(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return unmatched(documents, table(spark, sf_dir, "labels"), "doc_id", normalised=False)


@query("SELECT count(DISTINCT nullif(user_id, 3)) AS distinct_values FROM events")
def distinct_count(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.nullif(F.col("user_id"), F.lit(3)).alias("user_id"))
    return count_distinct(events, "user_id")


@query(
    "SELECT DISTINCT " + _NAME + " AS municipio FROM (SELECT 'Úser ' || user_id || '. x' AS title FROM events)"
)
def distinct_sorted_names(spark, sf_dir):
    titles = inputs.population_titles(spark, sf_dir)
    return distinct_sorted(titles.select(normalise(head_segment("municipio")).alias("municipio")), "municipio")


SERIES_SQL = """
series AS (
    SELECT CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_nationkey AS VARCHAR) ELSE '' END AS cod_prov,
           CASE WHEN c_custkey % 35 <> 0 THEN CAST(c_custkey AS VARCHAR) ELSE '' END AS cod_muni,
           CASE WHEN c_custkey % 7 <> 0 THEN c_name ELSE 'Desconocido' END AS municipio,
           year, population, periods_after
    FROM (
        SELECT o_custkey, CAST(extract(year FROM o_orderdate) AS INTEGER) AS year,
               CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) AS population,
               row_number() OVER (PARTITION BY o_custkey ORDER BY extract(year FROM o_orderdate) DESC) - 1 AS periods_after
        FROM orders GROUP BY o_custkey, extract(year FROM o_orderdate)
    ) JOIN customer ON o_custkey = c_custkey
    WHERE year % 4 <> 0
)"""


@query("WITH " + SERIES_SQL + " SELECT * EXCLUDE (periods_after) FROM series")
def series_observations(spark, sf_dir):
    return explode_series(inputs.municipal_entities(spark, sf_dir), defaults=SERIES_DEFAULTS)


@query(
    "WITH " + SERIES_SQL + """
SELECT * EXCLUDE (periods_after) FROM series WHERE periods_after < 2"""
)
def municipal_population_series(spark, sf_dir):
    return municipal_series(inputs.municipal_entities(spark, sf_dir), years=2)


@query(
    """
SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) <= 5"""
)
def latest_periods(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "ts")
    return latest_n(events, ["user_id"], "ts", 5, ["event_id"]).drop("ts")


@query(
    """
SELECT event_type, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) <= 1500"""
)
def latest_periods_deep(spark, sf_dir):
    """Many rows per series: only those of the period in which the last one lies are ranked."""
    events = table(spark, sf_dir, "events").select("event_type", "event_id", "ts")
    return latest_n(events, ["event_type"], "ts", 1500, ["event_id"]).drop("ts")


CUBE_SQL = """
cube AS (
    SELECT o_orderpriority AS doc, c_nationkey AS nation,
           CASE WHEN n_regionkey < 3 THEN 'ES' ELSE 'FR' END || (n_nationkey + 100) AS code, n_name AS label,
           CAST(extract(year FROM o_orderdate) AS INTEGER) AS year, CAST(count(*) AS DOUBLE) AS value,
           NOT (o_orderpriority = '1-URGENT' AND n_nationkey = 24) AS in_range
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY ALL
)"""


def _cube(spark, sf_dir):
    return split_cube(inputs.cube_documents(spark, sf_dir), inputs.CUBE_ORDER)


@query(
    "WITH " + CUBE_SQL + """
SELECT doc, CAST(year AS VARCHAR) AS time_code, CAST(year AS VARCHAR) AS time_label,
       code AS geo_code, label AS geo_label, value
FROM cube WHERE in_range"""
)
def cube_cells(spark, sf_dir):
    return decode_documents(inputs.cube_documents(spark, sf_dir), inputs.CUBE_ORDER)


@query(
    "WITH " + CUBE_SQL + """
SELECT CAST(year AS VARCHAR) AS time_code, CAST(year AS VARCHAR) AS time_label, code AS geo_code, label AS geo_label, value
FROM cube WHERE in_range"""
)
def cube_files(spark, sf_dir):
    """Cubes landed one document a file, read by file; cells and dimensions as tables, joined."""
    path = scratch(spark, "cubes")
    documents = inputs.cube_documents(spark, sf_dir)
    documents.select(F.col("text").alias("value"), F.xxhash64("doc").alias("part")).repartition("part").write.partitionBy("part").text(path)
    cells, dims = read_cube(spark, path, inputs.CUBE_ORDER)
    return decode_cube(cells, dims, inputs.CUBE_ORDER).drop("doc")


@query("WITH " + CUBE_SQL + " SELECT doc, count(*) AS cells, sum(value) AS value FROM cube WHERE NOT in_range GROUP BY doc")
def cube_cells_out_of_range(spark, sf_dir):
    cells, _ = _cube(spark, sf_dir)
    return cube_out_of_range(cells).groupBy("doc").agg(
        F.count(F.lit(1)).alias("cells"), F.sum("value").alias("value")
    )


@query(
    "WITH " + CUBE_SQL + """
SELECT code AS region_code, label AS region_name, year, value AS population
FROM cube WHERE in_range AND code LIKE 'ES%'"""
)
def provincial_population_series(spark, sf_dir):
    return provincial_population_of(inputs.cube_documents(spark, sf_dir), inputs.CUBE_ORDER)


@query("SELECT p_partkey, p_brand FROM part WHERE p_brand LIKE 'Brand#1%' AND length(p_brand) = 8")
def code_prefix(spark, sf_dir):
    return prefix(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_brand", "Brand#1", length=8)


@query(
    """
SELECT c_custkey,
       CASE WHEN c_custkey % 4 = 0 THEN NULL
            ELSE CAST(json_object('name', 'Peñíscola ' || c_custkey, 'segment', nullif(c_mktsegment, 'BUILDING')) AS VARCHAR) END AS tags
FROM customer"""
)
def json_texts(spark, sf_dir):
    tags = F.create_map(
        F.lit("name"), F.concat(F.lit("Peñíscola "), "c_custkey"),
        F.lit("segment"), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")),
    )
    empty = F.from_json(F.lit("{}"), "map<string,string>")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", json_text(F.when(F.col("c_custkey") % 4 == 0, empty).otherwise(tags)).alias("tags")
    )
