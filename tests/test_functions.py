from datetime import date

import pytest
from helpers import rows, value
from pyspark.sql import functions as F

from themelake.fixed_values import AOIS, SEX_CATEGORIES
from themelake.functions import (
    any_attr_le, attr, bbox, box_of, center_or_point, edge_list, even_odd, extract_category, fallback,
    head_segment, identifier, instant, json_text, level, local_date, month_label, normalise, parse_rings,
    rings_of, strip,
)


@pytest.mark.parametrize(
    "text, expected",
    [("  a b ", "a b"), (" x\t\n", "x"), ("\x1fx ", "x"), ("", ""), (None, None), ("x\n", "x")],
)
def test_strip_takes_every_white_space(spark, text, expected):
    assert value(spark, strip("t"), t=F.lit(text).cast("string")) == expected


@pytest.mark.parametrize(
    "text, expected", [(" Abades . Total. x", "Abades"), ("sin punto ", "sin punto"), (".x", ""), (None, None)]
)
def test_head_segment(spark, text, expected):
    assert value(spark, head_segment("t"), t=F.lit(text).cast("string")) == expected


@pytest.mark.parametrize(
    "name, expected", [("S2A_X.SAFE", "S2A_X"), ("no_dot", "no_dot"), ("", "id1"), (None, "id1"), ("a.b.c", "a")]
)
def test_identifier_falls_back_to_the_id(spark, name, expected):
    assert value(spark, identifier("n", "i"), n=F.lit(name).cast("string"), i="id1") == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("A. Total", "Total"), ("A. Hombres. x", "Hombres"), ("B. x", None), ("Totalán. Mujeres", "Mujeres"),
        ("Total Hombres", "Total"), ("total", None), (None, None), ("ñTotal", None), ("_Total", None),
    ],
)
def test_category_is_a_whole_word(spark, text, expected):
    assert value(spark, extract_category("t", SEX_CATEGORIES), t=F.lit(text).cast("string")) == expected


@pytest.mark.parametrize(
    "text, expected",
    [(" ÁBÁRZUZA ", "abarzuza"), ("L’Hospitalet", "l'hospitalet"), ("Güeñes", "guenes"), ("Çà", "çà"), (None, None)],
)
def test_normalise_folds_the_listed_accents_only(spark, text, expected):
    assert value(spark, normalise("t"), t=F.lit(text).cast("string")) == expected


def test_level(spark):
    df = spark.createDataFrame([("S2A_MSIL2A_x",), ("S2A_MSIL1C_x",), (None,)], "n string")
    assert [r[0] for r in df.select(level("n")).collect()] == ["L2A", "unknown", "unknown"]


def test_json_text_keeps_accents_and_drops_empty(spark):
    df = spark.createDataFrame([({"a": "ñ", "b": None},), ({},), (None,)], "m map<string,string>")
    assert [r[0] for r in df.select(json_text("m")).collect()] == ['{"a":"ñ","b":null}', None, None]
    assert [r[0] for r in df.select(json_text("m", empty_as_null=False)).collect()][1] == "{}"


ATTRS = "id int, a array<map<string,string>>"


def test_attr_takes_the_first_by_name(spark):
    df = spark.createDataFrame(
        [
            (1, [{"Name": "x"}, {"Name": "cloudCover", "Value": "0"}, {"Name": "CloudShadow", "Value": "9"}]),
            (2, [{"Name": "CLOUD", "value": "5"}]),
            (3, [{"Name": "cloud", "doubleValue": "1.5"}]),
            (4, [{"Name": "cloud", "stringValue": "s"}]),
            (5, [{"Name": "cloud", "Value": None}, {"Name": "cloud2", "Value": "7"}]),
            (6, [{"Name": None, "Value": "1"}]), (7, []), (8, None),
        ],
        ATTRS,
    )
    got = {r["id"]: r["v"] for r in df.select("id", attr("a", "cloud").alias("v")).collect()}
    assert got == {1: "0", 2: "5", 3: "1.5", 4: "s", 5: None, 6: None, 7: None, 8: None}


def test_attribute_threshold_is_exact_by_name(spark):
    df = spark.createDataFrame(
        [
            (1, [{"Name": "CloudCover", "Value": "40"}]), (2, [{"Name": "CloudCover", "Value": "40.1"}]),
            (3, [{"Name": "cloudcover", "Value": "1"}]), (4, [{"Name": "CloudCover", "Value": "n/a"}]), (5, None),
        ],
        ATTRS,
    )
    got = {r["id"]: r["v"] for r in df.select("id", any_attr_le("a", "CloudCover", 40).alias("v")).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: False}


def test_zero_is_a_value(spark):
    df = spark.createDataFrame([(0.0, 5.0), (None, 5.0), (None, None)], "a double, b double")
    assert [r[0] for r in df.select(fallback("a", "b")).collect()] == [0.0, 5.0, None]
    assert [r[0] for r in df.select(center_or_point("a", "b")).collect()] == [0.0, 5.0, None]


def test_instants_and_labels(spark):
    df = spark.createDataFrame(
        [("2024-03-31T01:30:00.000Z",), ("2024-03-31T03:30:00+02:00",), ("bad",), (None,)], "t string"
    )
    got = df.select(F.unix_timestamp(instant("t")), month_label(instant("t"))).collect()
    assert [tuple(r) for r in got] == [(1711848600, "2024-03"), (1711848600, "2024-03"), (None, None), (None, None)]


@pytest.mark.parametrize(
    "seconds, expected",
    [(1704063599, date(2023, 12, 31)), (1704063600, date(2024, 1, 1)), (1729893600, date(2024, 10, 26))],
)
def test_local_date_in_madrid(spark, seconds, expected):
    assert value(spark, local_date("s", "Europe/Madrid"), s=seconds) == expected


def test_peninsula_box(spark):
    got = value(spark, bbox("r"), r=parse_rings(F.lit(AOIS["peninsula"])))
    assert tuple(got) == (36.0, -9.5, 43.8, 3.3)
    assert box_of(rings_of(spark, AOIS["madrid"])) == (40.2, -3.9, 40.6, -3.3)


def test_parse_rings_reads_holes_and_parts(spark):
    text = "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1)), ((10 0, 11 0, 11 1e0, 10 0)))"
    got = value(spark, parse_rings("w"), w=text)
    assert [len(r) for r in got] == [5, 5, 4] and got[2][2]["y"] == 1.0


def test_invalid_polygon_fails(spark):
    with pytest.raises(Exception, match="invalid polygon"):
        spark.createDataFrame([("POINT(1 2)",)], "w string").select(parse_rings("w")).collect()
    assert value(spark, parse_rings("w"), w=F.lit(None).cast("string")) is None


def test_even_odd_with_hole_and_half_open_border(spark):
    text = "POLYGON((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))"
    points = [(0.5, 0.5), (1.5, 1.5), (3.0, 3.0), (5.0, 1.0), (0.0, 0.0), (4.0, 0.0), (0.0, 4.0), (2.0, 1.5)]
    df = spark.createDataFrame(points, "x double, y double").withColumn("r", parse_rings(F.lit(text)))
    got = {(r["x"], r["y"]) for r in df.withColumn("e", edge_list("r")).where(even_odd("e", "x", "y")).collect()}
    assert got == {(0.5, 0.5), (3.0, 3.0), (0.0, 0.0), (2.0, 1.5)}


def test_rows_helper_sorts(spark):
    assert rows(spark.createDataFrame([(2,), (1,)], "a int")) == [(1,), (2,)]
