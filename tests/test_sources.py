import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from themelake.operators import stack
from themelake.sinks import save_theme, save_theme_json
from themelake.sources import (
    CATALOGUE_ITEM, SERIES_ITEM, cube_out_of_range, decode_cube, explode_series, nan_to_null, read_csv, read_csv_set,
    read_cube, read_paged_json, read_zones,
)
from themelake.sources.cube import split_cube

ORDER = ("time", "geo")


def put(folder, name, content):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(content if isinstance(content, str) else json.dumps(content, ensure_ascii=False, indent=1))
    return str(folder)


def test_pages_that_span_lines(spark, tmp_path):
    put(tmp_path, "1.json", {"@odata.count": 3, "value": [{"Id": "a", "Name": "n"}, {"Id": "b"}], "@odata.nextLink": "x"})
    put(tmp_path, "2.json", {"value": []})
    put(tmp_path, "3.json", {"@odata.count": 3})
    path = put(tmp_path, "4.json", {"value": [{
        "Id": "c", "Attributes": [{"Name": "CloudCover", "Value": 1.5, "value": "low"}], "ContentDate": {"Start": "s"},
    }]})
    df = read_paged_json(spark, path, CATALOGUE_ITEM)
    assert rows(df.select("Id", "Name", "ContentDate.Start")) == [("a", "n", None), ("b", None, None), ("c", None, "s")]
    (attributes,) = [r[0] for r in df.where("Id = 'c'").select("Attributes").collect()]
    assert attributes == [{"Name": "CloudCover", "Value": "1.5", "value": "low"}]


def test_pages_one_per_line(spark, tmp_path):
    lines = "\n".join(json.dumps({"value": [{"Id": str(i)}]}) for i in range(5))
    path = put(tmp_path, "pages.json", lines)
    assert read_paged_json(spark, path, "Id string", one_page_per_line=True).count() == 5


def test_csv_types_and_missing_cells(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'date,n,x,s\n2018-01,1,1.5,"a ""q"", b"\n2018-02,NaN,,N/A\n2018-03,3,2,é\n')
    df = read_csv(spark, path)
    assert df.dtypes == [("date", "string"), ("n", "bigint"), ("x", "double"), ("s", "string")]
    assert rows(df) == [("2018-01", 1, 1.5, 'a "q", b'), ("2018-02", None, None, None), ("2018-03", 3, 2.0, "é")]


def test_csv_schema_is_by_name_and_dirty_cells_are_missing(spark, tmp_path):
    path = put(tmp_path, "a.csv", "b,a\nx,1\ny,oops\n")
    assert rows(read_csv(spark, path, "a int, b string"), "b", "a") == [("x", 1), ("y", None)]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, "b")], "v double, s string")
    assert rows(nan_to_null(df)) == [(1.0, "b"), (None, "a")]
    assert nan_to_null(df).agg(F.avg("v")).first()[0] == 1.0


def test_csv_set_matches_by_header_name(spark, tmp_path):
    put(tmp_path, "viirs_bloque_0.csv", "LAU_NAME,mean\nA,1.0\n")
    put(tmp_path, "viirs_bloque_1.csv", "mean,LAU_NAME\n2.0,B\n")
    put(tmp_path, "viirs_bloque_2.csv", "LAU_NAME,mean,extra\nC,3.0,x\n")
    path = put(tmp_path, "other.csv", "LAU_NAME,mean\nZ,9\n")
    expected = [("A", 1.0, None), ("B", 2.0, None), ("C", 3.0, "x")]
    assert rows(read_csv_set(spark, path, "viirs_bloque_"), "LAU_NAME", "mean", "extra") == expected
    with_schema = read_csv_set(spark, path, "viirs_bloque_", "LAU_NAME string, mean double, extra string")
    assert rows(with_schema, "LAU_NAME", "mean", "extra") == expected


def test_csv_set_without_files(spark, tmp_path):
    assert read_csv_set(spark, put(tmp_path, "x.csv", "a\n1\n"), "viirs_bloque_") is None
    assert stack([]) is None


def cube(geo, time, values):
    return {
        "dimension": {"geo": {"category": {"label": geo}}, "time": {"category": {"label": time}}}, "value": values,
    }


def test_cube_worked_example(spark, tmp_path):
    path = put(tmp_path, "c.json", cube(
        {"ES111": "A Coruña", "FR101": "Paris"}, {"2020": "2020", "2021": "2021"}, {"0": 10, "1": 20, "3": 40},
    ))
    cells, dims = read_cube(spark, path, ORDER)
    assert rows(decode_cube(cells, dims, ORDER), "geo_code", "geo_label", "time_code", "value") == [
        ("ES111", "A Coruña", "2020", 10.0), ("FR101", "Paris", "2020", 20.0), ("FR101", "Paris", "2021", 40.0),
    ]


def test_cube_keeps_text_order_and_reports_bad_indexes(spark, tmp_path):
    geo = {f"Z{9 - i}": f"n{i}" for i in range(10)}
    path = put(tmp_path, "c.json", cube(geo, {"2021": "b", "2020": "a"}, {"0": 1, "12": 2, "20": 3, "5": None}))
    cells, dims = read_cube(spark, path, ORDER)
    assert rows(decode_cube(cells, dims, ORDER), "geo_code", "time_code", "value") == [
        ("Z4", "2021", None), ("Z7", "2020", 2.0), ("Z9", "2021", 1.0),
    ]
    assert rows(cube_out_of_range(cells), "flat", "value") == [("20", 3.0)]
    with pytest.raises(Exception, match="past the axes"):
        decode_cube(cells, dims, ORDER, strict=True).collect()


def test_cubes_of_several_documents_stay_apart(spark, tmp_path):
    put(tmp_path, "a.json", cube({"ES1": "x"}, {"2020": "2020"}, {"0": 1}))
    path = put(tmp_path, "b.json", cube({"ES2": "y", "ES3": "z"}, {"2019": "2019"}, {"1": 2}))
    cells, dims = read_cube(spark, path, ORDER)
    assert rows(decode_cube(cells, dims, ORDER), "geo_code", "time_code", "value") == [("ES1", "2020", 1.0), ("ES3", "2019", 2.0)]


def test_series_defaults_and_dropped_values(spark, tmp_path):
    path = put(tmp_path, "s.json", "\n".join(json.dumps(e) for e in [
        {"Nombre": "A. Total", "CODPROV": "1", "CODMUNI": "2", "Data": [{"Anyo": 2020, "Valor": 0.0}, {"Anyo": 2021, "Valor": None}]},
        {"Data": [{"Anyo": 2019, "Valor": 5.0}]}, {"Nombre": "empty", "Data": []}, {"Nombre": "absent"},
    ]))
    df = explode_series(spark.read.schema(SERIES_ITEM).json(path))
    assert rows(df) == [("", "", "Desconocido", 2019, 5.0), ("1", "2", "A. Total", 2020, 0.0)]


def feature(kind, coordinates, **properties):
    return {"type": "Feature", "properties": properties, "geometry": {"type": kind, "coordinates": coordinates}}


SQUARE = [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]


@pytest.mark.parametrize("lines", [False, True])
def test_zones(spark, tmp_path, lines):
    features = [
        feature("Polygon", [SQUARE], ID="a", LAU_NAME="Ñ"),
        feature("MultiPolygon", [[SQUARE], [[[5, 5], [6, 5], [6, 6.5], [5, 5]]]], ID="b"),
        feature("Point", [0, 0], ID="c"),
    ]
    content = "\n".join(map(json.dumps, features)) if lines else {"type": "FeatureCollection", "features": features}
    path = put(tmp_path, "z.geojson", content)
    zones = read_zones(spark, path, {"ID": "zone_id", "LAU_NAME": "LAU_NAME"}, one_feature_per_line=lines)
    got = {r["zone_id"]: (r["LAU_NAME"], [len(x) for x in r["rings"]]) for r in zones.collect()}
    assert got == {"a": ("Ñ", [5]), "b": (None, [5, 4])}


def test_cut_off_page_stops_the_job(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"value": [{"Id": "1"}]}')
    (tmp_path / "b.json").write_text('{"value": [{"Id": "2"}, {"Id"')
    with pytest.raises(Exception, match="(?i)malformed"):
        read_paged_json(spark, str(tmp_path), "Id string").collect()
    assert read_paged_json(spark, str(tmp_path), "Id string", mode="PERMISSIVE").count() == 1


def test_cube_with_marks_for_gaps(spark):
    text = '{"dimension":{"geo":{"category":{"label":{"ES":"E","FR":"F"}}},"time":{"category":{"label":{"2020":"a"}}}},"value":{"0":1,"1":":"}}'
    cells, dims = split_cube(spark.createDataFrame([("d", text)], "doc string, text string"), ("time", "geo"))
    assert rows(decode_cube(cells, dims, ("time", "geo")), "geo_code", "value") == [("ES", 1.0), ("FR", None)]


def test_cells_with_line_breaks(spark, tmp_path):
    path = save_theme(spark.createDataFrame([(1, "a\nb"), (2, 'c"\r\n"d')], "i int, s string"), "transporte", "x", str(tmp_path))
    assert rows(read_csv(spark, path, "i int, s string")) == [(1, "a\nb"), (2, 'c"\r\n"d')]


def test_json_keeps_missing_values(spark, tmp_path):
    path = save_theme_json(spark.createDataFrame([(1, None)], "i int, s string"), "transporte", "x", str(tmp_path))
    assert spark.read.text(path).first()[0] == '{"i":1,"s":null}'
