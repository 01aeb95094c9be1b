from datetime import date, datetime, timedelta

from helpers import rows
from pyspark.sql import functions as F

from themelake.fixed_values import AOIS
from themelake.operators import trailing_days
from themelake.plans.jobs import (
    Dataset, asset_run, clean_night_lights, clean_population, municipal_series, product_catalogue, province_table,
    provincial_population, rail_stations, run_all, weather_repair,
)
from themelake.sources import CATALOGUE_ITEM, MAP_ELEMENT, SERIES_ITEM, WEATHER_RESPONSE
from themelake.sources.cube import split_cube

POPULATION = [
    ("A. Total", 1, 1.0), ("A. Total", 1, 3.0), ("A. Hombres", 1, 2.0), ("B. x", 1, 9.0), ("C. Total", 1, None),
    (None, 1, 5.0), (" ÁBÁRZUZA . Mujeres", 1, 4.0), ("Totalán. Mujeres", 1, 7.0), ("Ababuj. Total", 2, 8.0),
]


def test_population_edge_rows(spark):
    series = spark.createDataFrame(POPULATION, "municipio string, year int, population double")
    got = clean_population(series, province_table(spark))
    assert got.columns == ["municipio", "year", "total", "hombres", "mujeres", "provincia"]
    assert rows(got) == [
        ("a", 1, 2.0, 2.0, None, "Desconocida"), ("ababuj", 2, 8.0, None, None, "Teruel"),
        ("abarzuza", 1, None, None, 4.0, "Navarra"), ("totalan", 1, None, None, 7.0, "Desconocida"),
    ]


def test_population_two_spellings(spark):
    series = spark.createDataFrame([("Á. Total", 1, 1.0), ("A. Total", 1, 3.0)], "municipio string, year int, population double")
    assert rows(clean_population(series, province_table(spark)), "municipio", "total") == [("a", 2.0)]
    assert rows(clean_population(series, province_table(spark), normalise_after=True), "municipio", "total") == [("a", 1.0), ("a", 3.0)]


def test_population_plan(spark, plan, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame(POPULATION, "municipio string, year int, population double").write.parquet(path)
    text = plan(clean_population(spark.read.parquet(path), province_table(spark)))
    assert text.count("regexp_extract") == 1  # not repeated by the filters above it
    assert "IsNotNull(municipio)" in text and "BatchEvalPython" not in text and "ArrowEval" not in text


def test_night_lights(spark):
    table = spark.createDataFrame(
        [("A", "2018-01", 1.0, 1), ("A", "2018-01", 3.0, 2), ("B", "2018-01", 5.0, 3)],
        "LAU_NAME string, file_DATE string, mean double, i int",
    )
    assert rows(clean_night_lights(table, "i")) == [("A", "2018-01", 2.0), ("B", "2018-01", 5.0)]
    assert rows(clean_night_lights(table, "i", keys=["date"])) == [("2018-01", 3.0, "A")]


def test_product_catalogue(spark):
    def product(id_, start, name, collection="SENTINEL-2", cloud=None):
        from pyspark.sql import types as T

        values = {
            "Id": id_, "Name": name, "ContentDate": (start, None), "collection": collection,
            "Attributes": [{"Name": "CloudCover", "Value": str(cloud)}] if cloud is not None else [],
        }
        return tuple(values.get(n) for n in T.StructType.fromDDL(CATALOGUE_ITEM).names)

    items = spark.createDataFrame(
        [
            product("a", "2024-01-02T00:00:00.000Z", "x_L2A.SAFE", cloud=0), product("b", "2024-01-03T00:00:00.000Z", "y_L2A.SAFE", cloud=10),
            product("c", "2024-01-03T00:00:00.000Z", "z_L1C.SAFE", cloud=0), product("d", "2024-01-04T00:00:00.000Z", "w_L2A.SAFE", cloud=90),
            product("e", "2025-01-04T00:00:00.000Z", "w_L2A.SAFE", cloud=0), product("f", "2024-01-04T00:00:00.000Z", "s.SAFE", "SENTINEL-1"),
        ],
        CATALOGUE_ITEM,
    )
    window = (date(2024, 1, 1), date(2024, 12, 31))
    got = product_catalogue(items, "sentinel2", "SENTINEL-2", *window, max_cloud=40, exclude="L1C")
    assert sorted(r["Id"] for r in got.collect()) == ["a", "b"]
    assert [r["Id"] for r in product_catalogue(items, "sentinel2", "SENTINEL-2", *window, top=1, max_pages=2).collect()] == ["d", "b"]
    flat = product_catalogue(items, None, "SENTINEL-2", *window)
    assert sorted(r["identifier"] for r in flat.collect()) == ["w_L2A", "x_L2A", "y_L2A", "z_L1C"] and "ContentDate.Start" in flat.columns
    assert [r["Id"] for r in product_catalogue(items, "sentinel1", "SENTINEL-1", *window, max_cloud=40).collect()] == ["f"]


def test_rail_stations(spark):
    elements = spark.createDataFrame(
        [
            ("node", 1, 40.3, -3.5, None, {"railway": "station", "station": "rail", "name": "Ñ"}),
            ("way", 2, None, None, (40.4, -3.4), {"railway": "station"}), ("way", 3, None, None, (50.0, 0.0), {"railway": "station"}),
            ("node", 4, 40.3, -3.5, None, {"railway": "halt"}), ("relation", 5, None, None, None, {"railway": "station"}),
        ],
        MAP_ELEMENT,
    )
    got = rail_stations(elements, AOIS["madrid"])
    assert rows(got, "osm_id", "name", "lat", "lon") == [(1, "Ñ", 40.3, -3.5), (2, None, 40.4, -3.4)]
    assert got.where("osm_id = 2").first()["tags"] == '{"railway":"station"}'


def test_provincial_population(spark):
    text = '{"dimension":{"geo":{"category":{"label":{"ES":"E","FR1":"F","ES11":"G"}}},"time":{"category":{"label":{"2020":"a","2021":"b"}}}},"value":{"0":1,"1":2,"5":3}}'
    cells, dims = split_cube(spark.createDataFrame([("d", text)], "doc string, text string"), ("time", "geo"))
    assert rows(provincial_population(cells, dims)) == [("ES", "E", 2020, 1.0), ("ES11", "G", 2021, 3.0)]


def test_municipal_series(spark):
    entities = spark.createDataFrame([("n", "1", "2", [(y, float(y)) for y in range(2000, 2010)])], SERIES_ITEM)
    assert rows(municipal_series(entities, 2).select("year")) == [(2008,), (2009,)]
    assert municipal_series(entities).count() == 10


def test_municipal_series_counts_in_each_entity(spark, plan):
    unnamed = [(None, None, None, [(2020, 1.0), (2019, 2.0)]), (None, None, None, [(2019, 4.0), (2020, 3.0), (2018, 5.0)])]
    gap = ("n", "1", "2", [(2019, 1.0), (2021, None), (2020, 2.0)])
    got = municipal_series(spark.createDataFrame([*unnamed, gap, ("e", "1", "2", None)], SERIES_ITEM), 2)
    assert rows(got.select("municipio", "year", "population")) == [
        ("Desconocido", 2019, 2.0), ("Desconocido", 2019, 4.0), ("Desconocido", 2020, 1.0), ("Desconocido", 2020, 3.0), ("n", 2020, 2.0),
    ]
    assert "Window" not in plan(got) and "Exchange" not in plan(got)


STORE = "date date, tmax double, tmin double, precipitation_sum double, weather_code int"


def test_weather_repair_of_a_single_place(spark):
    day = lambda d: date(2024, 1, d)
    store = spark.createDataFrame(
        [(day(1), 1.0, 1.0, 1.0, 1), (day(5), 5.0, None, 5.0, 5), (day(6), 6.0, 6.0, 6.0, 6)], STORE
    )
    n, nan = [float(i) for i in range(1, 9)], float("nan")
    response = spark.createDataFrame(
        [(1704063600, 1704063600 + 8 * 86400, 86400, n, n, n[:3] + [nan] + n[4:], n, 1)], WEATHER_RESPONSE + ", batch int"
    )
    place = spark.range(1)
    fetched, after = weather_repair(store, response, place, day(8), [], "batch")
    assert [r[0].day for r in rows(fetched.select("date"))] == [2, 3, 5, 7]  # 4 has a NaN, 6 is complete, 8 is today
    assert {r["date"].day: r["tmin"] for r in after.collect()} == {1: 1.0, 2: 2.0, 3: 3.0, 5: 5.0, 6: 6.0, 7: 7.0}
    _, again = weather_repair(after, response, place, day(8), [], "batch")
    assert rows(again) == rows(after)
    assert spark.range(1).select(F.size(trailing_days(day(8)))).first()[0] == 7


def test_asset_run(spark):
    products = spark.createDataFrame(
        [("p1", "N1.SAFE", 1), ("p2", None, 2), ("p3", "N3.SAFE", 3), (None, "N4.SAFE", 4), ("p5", "N5.SAFE", 0)],
        "product_id string, Name string, content_start int",
    )
    members = spark.createDataFrame(
        [("p1", "a/TCI.jp2"), ("p1", "a/TCI.jp2"), ("p2", "a/x.txt"), ("p3", "a/TCI.jp2"), ("p5", "a/TCI.jp2")],
        "product_id string, member string",
    )
    done = spark.createDataFrame([("p3",)], "product_id string")
    assets, statuses = asset_run(products, members, done, "tci", max_products=3)
    assert rows(assets) == [("p1", "a/TCI.jp2")]
    assert rows(statuses, "identifier", "status", "assets") == [
        ("N1", "ok", 1), ("N4", "no-id", 0), ("p2", "p2: no assets matched", 0),
    ]


def test_asset_run_takes_all(spark):
    products = spark.range(30).selectExpr("concat('p', id) AS product_id", "concat('N', id) AS Name", "id AS content_start")
    members = products.selectExpr("product_id", "'a/TCI.jp2' AS member")
    assets, statuses = asset_run(products, members, products.limit(0), "tci")
    assert assets.count() == statuses.where("status = 'ok'").count() == 30


def test_run_isolates_failures(spark, tmp_path):
    def broken():
        raise RuntimeError("no")

    good = spark.createDataFrame([(1, {"a": "b"})], "i int, m map<string,string>")
    got = run_all(
        spark,
        [Dataset("satelital", "bad", broken), Dataset("otro", "x", lambda: good), Dataset("satelital", "ok", lambda: good),
         Dataset("demografia", "none", lambda: None), Dataset("demografia", "zero", lambda: good.limit(0)),
         Dataset("transporte", "late", lambda: good.select(F.raise_error(F.lit("late")).alias("x")))],
        str(tmp_path),
    )
    status = {r["dataset"]: (r["rows"], r["status"]) for r in got.collect()}
    assert status["ok"] == (1, "ok") and status["none"] == status["zero"] == (0, "empty")
    assert all(status[k][1].startswith("failed: ") for k in ("bad", "x", "late"))
    assert status["bad"][1] == "failed: RuntimeError: no" and "unknown theme" in status["x"][1]
    assert spark.read.option("header", True).csv(str(tmp_path / "satelital" / "ok")).count() == 1


def test_weather_axis_covers_all_days(spark, tmp_path):
    from themelake.plans import queries_tables  # noqa: F401  (it registers the query)
    from themelake.plans.registry import QUERIES

    at = [datetime(2023, 12, 30, 23, 59), datetime(2024, 1, 15), datetime(2024, 3, 31, 1), datetime(2024, 10, 28, 0, 30)]
    events = spark.createDataFrame(
        [(i, i % 2, "view", t, float(i)) for i, t in enumerate(at)], "event_id long, user_id long, event_type string, ts timestamp, value double"
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    got = QUERIES["daily_expansion"](spark, str(tmp_path)).collect()
    days = [(at[0].date() + timedelta(n)).isoformat() for n in range(304)]
    assert days[-1] == "2024-10-28" and sorted((r.user_id, r.date) for r in got) == [(u, d) for u in (0, 1) for d in days]
    assert {(r.user_id, r.date, r.tmax) for r in got if r.tmax is not None} == {(i % 2, t.date().isoformat(), float(i)) for i, t in enumerate(at)}
    events.limit(0).write.parquet(f"{tmp_path}/none/events.parquet")
    assert QUERIES["daily_expansion"](spark, f"{tmp_path}/none").count() == 0
