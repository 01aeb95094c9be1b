from datetime import date, datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from themelake.fixed_values import AOIS
from themelake.functions import parse_rings
from themelake.operators import (
    any_attribute_le, complete, computed_once, flat_products, in_bbox, in_window, intersects_aoi, flatten, keep, lead_columns, name_filter, prefix,
    product_columns, standardise_names, tagged,
)
from themelake.sources import CATALOGUE_ITEM


def test_flatten_at_any_depth(spark):
    df = spark.createDataFrame(
        [(1, ((("x",), [1, 2]),))], "Id int, a struct<b:struct<c:struct<d:string>,e:array<int>>>"
    )
    assert flatten(df).columns == ["Id", "a.b.c.d", "a.b.e"]
    assert flatten(df).first()[1:] == ("x", [1, 2])
    assert flatten(df, "_").columns == ["Id", "a_b_c_d", "a_b_e"]


def test_flattened_names_can_lead_and_be_kept(spark):
    df = flatten(spark.createDataFrame([(1, ("s", "e"), "n")], "z int, ContentDate struct<Start:string,End:string>, Name string"))
    assert lead_columns(df).columns == ["Name", "ContentDate.Start", "ContentDate.End", "z"]
    assert keep(df, ["nope", "ContentDate.End", "z"]).columns == ["ContentDate.End", "z"]


@pytest.mark.parametrize(
    "names, expected",
    [
        (["LAU_NAME", "system_DATE", "UpDate"], ["municipio", "date", "UpDate"]),
        (["date", "OTHER_DATE"], ["date", "OTHER_DATE"]),
        (["x"], ["x"]),
    ],
)
def test_standard_names(spark, names, expected):
    df = spark.createDataFrame([tuple("a" * len(names))], names)
    assert standardise_names(df, {"LAU_NAME": "municipio"}).columns == expected


def item(spark, **values):
    from pyspark.sql import types as T

    schema = T.StructType.fromDDL(CATALOGUE_ITEM)
    return spark.createDataFrame([tuple(values.get(n) for n in schema.names)], schema)


def test_product_columns(spark):
    df = item(
        spark, Id="p1", Name="S2A_MSIL2A_x.SAFE", ContentDate=("2024-01-01T00:00:00.000Z", None), CloudCover=0.0,
        GeoFootprint=("Polygon", [[[0.0, 0.0]]]), Attributes=[{"Name": "cloudCover", "Value": "9"}], Assets=[],
    )
    row = product_columns(df, "sentinel2").first().asDict()
    assert row["cloudcover"] == 0.0 and row["identifier"] == "S2A_MSIL2A_x" and row["product_level"] == "L2A"
    assert row["footprint"] == '{"type":"Polygon","coordinates":[[[0.0,0.0]]]}' and row["s3_asset"] is None
    assert row["collection"] == "SENTINEL-2" and "polarizations" not in row


def test_product_columns_without_the_optional_ones(spark):
    df = item(spark, Id="p1").drop("Attributes", "Assets", "CloudCover", "GeoFootprint", "sizeInBytes")
    row = product_columns(df, "sentinel1").first().asDict()
    assert row["identifier"] == "p1" and row["polarizations"] is None and "sizeInBytes" not in row
    with pytest.raises(ValueError, match="unknown product theme"):
        product_columns(df, "sentinel3")


def test_flat_products(spark):
    df = item(spark, Id="p1", Name="a.b", ContentDate=("2024-01-01T00:00:00.000Z", "e"), ContentLength=3)
    flat = flat_products(df)
    assert flat.columns[:6] == ["Id", "Name", "ContentDate.Start", "ContentDate.End", "ContentType", "ContentLength"]
    row = flat.first()
    assert row["identifier"] == "a" and str(row["content_start"]).startswith("2024-01-01") and "GeoFootprint.type" in flat.columns


def test_computed_once_is_not_repeated(spark, plan):
    df = spark.createDataFrame([(" a ",)], "s string")
    text = plan(computed_once(df, t=F.md5("s")).where("t != 'x' AND length(t) > 3"))
    assert text.count("md5(") == 1


STARTS = [
    "2023-12-31T23:59:59.999Z", "2024-01-01T00:00:00.000Z", "2024-01-01T00:00:00.001Z", "2024-01-31T00:00:00.000Z",
    "2024-01-31T23:59:59.999Z", "2024-02-01T00:00:00.000Z",
]


@pytest.mark.parametrize("kind", ["string", "timestamp", "timestamp_ntz"])
def test_window_edges(spark, kind):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(STARTS)], "i int, s string")
    if kind != "string":
        df = df.withColumn("s", F.col("s").cast(kind))
    df = df.select("i", F.col("s").alias("content_start"), F.lit("SENTINEL-2").alias("collection"))

    def found(closed):
        return [r[0] for r in rows(in_window(df, "SENTINEL-2", date(2024, 1, 1), date(2024, 1, 31), closed), "i")]

    assert found("both") == [1, 2, 3, 4]
    assert found("neither") == [2]
    assert in_window(df, "SENTINEL-1", date(2024, 1, 1), date(2024, 1, 31)).count() == 0
    with pytest.raises(ValueError):
        found("left")


def test_window_reaches_the_scan(spark, plan, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("SENTINEL-2", datetime(2024, 1, 5), "x")], "collection string, content_start timestamp, other string").write.parquet(path)
    text = plan(in_window(spark.read.parquet(path), "SENTINEL-2", date(2024, 1, 1), date(2024, 1, 31)).select("collection"))
    assert "GreaterThanOrEqual(content_start" in text and "EqualTo(collection,SENTINEL-2)" in text
    assert "other" not in text.split("ReadSchema")[1]


POLYGONS = {
    "inside": "POLYGON((0.2 0.2, 0.4 0.2, 0.4 0.4, 0.2 0.2))",
    "around": "POLYGON((-5 -5, 5 -5, 5 5, -5 5, -5 -5))",
    "crossing": "POLYGON((0.5 0.5, 3 0.5, 3 0.6, 0.5 0.5))",
    "cross without vertices inside": "POLYGON((-1 0.4, 2 0.4, 2 0.6, -1 0.6, -1 0.4))",
    "touching corner": "POLYGON((1 1, 2 1, 2 2, 1 1))",
    "touching side": "POLYGON((1 0.2, 2 0.2, 2 0.8, 1 0.8, 1 0.2))",
    "around, but the area is in its hole": "POLYGON((-5 -5, 5 -5, 5 5, -5 5, -5 -5), (-2 -2, 3 -2, 3 3, -2 3, -2 -2))",
    "box overlaps, polygon does not": "POLYGON((0.9 2, 3 0.2, 3 2, 0.9 2))",
    "far": "POLYGON((7 7, 8 7, 8 8, 7 7))",
    "second part inside": "MULTIPOLYGON(((7 7, 8 7, 8 8, 7 7)), ((0.2 0.2, 0.4 0.2, 0.4 0.4, 0.2 0.2)))",
}


def test_area_of_interest(spark):
    df = spark.createDataFrame(list(POLYGONS.items()), "name string, wkt string").withColumn("rings", parse_rings("wkt"))
    got = {r["name"] for r in intersects_aoi(df, "rings", AOIS["tiny"]).collect()}
    assert got == {
        "inside", "around", "crossing", "cross without vertices inside", "touching corner", "touching side",
        "second part inside",
    }
    assert intersects_aoi(df, "rings", AOIS["tiny"]).columns == df.columns


def test_cloud_limit_is_optional_and_for_sentinel_2(spark):
    df = spark.createDataFrame(
        [(1, "SENTINEL-2", [{"Name": "CloudCover", "Value": "0"}]), (2, "SENTINEL-2", [{"Name": "CloudCover", "Value": "41"}]),
         (3, "SENTINEL-1", [])],
        "i int, collection string, Attributes array<map<string,string>>",
    )
    assert rows(any_attribute_le(df, 40).select("i")) == [(1,), (3,)]
    assert any_attribute_le(df, None).count() == 3


def test_name_filter(spark):
    df = spark.createDataFrame(
        [("SENTINEL-2", "S2_L1C_T30"), ("SENTINEL-2", "S2_L2A_T30"), ("SENTINEL-1", "S1_L1C_T30"), ("SENTINEL-2", "S2_L2A_T31")],
        "collection string, Name string",
    )
    assert rows(name_filter(df, include="T30"), "Name") == [("S1_L1C_T30",), ("S2_L2A_T30",)]
    assert name_filter(df, exclude=None).count() == 4


def test_box_border_counts(spark):
    df = spark.createDataFrame([(36.0, -9.5), (43.8, 3.3), (35.99, 0.0), (0.0, 0.0), (40.0, None)], "lat double, lon double")
    assert rows(in_bbox(df, "lat", "lon", (36.0, -9.5, 43.8, 3.3))) == [(36.0, -9.5), (43.8, 3.3)]
    assert rows(in_bbox(df, "lat", "lon", (0, 0, 0, 0))) == [(0.0, 0.0)]


def test_tag_rules_give_each_element_once(spark):
    df = spark.createDataFrame(
        [
            ("node", 1, {"railway": "station", "station": "rail"}), ("node", 2, {"station": "rail"}),
            ("way", 3, {"station": "rail"}), ("way", 4, {"railway": "station"}), ("relation", 5, {"railway": "station"}),
            ("node", 6, {"railway": "halt"}), ("node", 7, None), ("node", 8, {}),
        ],
        "type string, id int, tags map<string,string>",
    )
    assert rows(tagged(df).select("id")) == [(1,), (2,), (4,), (5,)]
    assert rows(tagged(df, [("node", "railway", "station")]).select("id")) == [(1,)]


def test_code_prefix_keeps_every_level(spark):
    df = spark.createDataFrame([("ES",), ("ES11",), ("ES111",), ("FR101",), (None,)], "c string")
    assert rows(prefix(df, "c", "ES")) == [("ES",), ("ES11",), ("ES111",)]
    assert rows(prefix(df, "c", "ES", length=5)) == [("ES111",)]


def test_complete_rows(spark):
    df = spark.createDataFrame(
        [(1, 1.0, "2", 3.0), (2, float("nan"), "2", 3.0), (3, None, "2", 3.0), (4, 1.0, "x", 3.0), (5, 1.0, "2", float("nan"))],
        "i int, a double, b string, c double",
    )
    got = complete(df, {"a": "double", "b": "int", "c": "int"})
    assert rows(got) == [(1, 1.0, 2, 3)] and dict(got.dtypes)["c"] == "int"


def test_window_on_text_of_any_fraction(spark):
    texts = ["2024-06-30T23:59:59Z", "2024-06-30T23:59:59.000Z", "2024-06-30T23:59:59.9991Z", "2024-07-01T00:00:00Z", "2024-07-01T01:30:00+02:00", "x", None]
    df = spark.createDataFrame([(t, "c", i) for i, t in enumerate(texts)], "content_start string, collection string, i int")
    got = in_window(df, "c", date(2024, 6, 1), date(2024, 6, 30))
    assert rows(got.select("i")) == [(0,), (1,), (4,)]
