"""Items whose fields are not known before."""

import json

import pytest
from pyspark.sql import functions as F

from themelake.functions import geojson_rings
from themelake.operators import product_columns
from themelake.sinks import save_theme
from themelake.sources import CATALOGUE_ITEM, flatten_open, item_fields, read_open_items, read_paged_json

SQUARE = [[[0, 0], [1, 0], [1, 1], [0, 0]]]
ITEMS = [
    {"Id": "a", "GeoFootprint": {"type": "Polygon", "coordinates": SQUARE}, "n": 1, "a b": {"c.d": 1, "it's": True}, "gone": None},
    {"Id": "b", "GeoFootprint": {"type": "MultiPolygon", "coordinates": [SQUARE, [[[5, 5], [6, 5], [6, 7.5]]]]}, "n": 2.5, "New": {"x": {"y": "ñ"}}},
    {"Id": "c", "ID": 7, "n": 3, "New": {"x": {"y": None}}, "GeoFootprint": None, "Attributes": [{"Name": "q", "Value": 1}, {"Name": "q", "value": "1"}]},
    {"Id": 9, "New": "now a text"},
]


def put(folder, *pages):
    folder.mkdir(parents=True, exist_ok=True)
    for i, p in enumerate(pages):
        (folder / f"{i}.json").write_text(p if isinstance(p, str) else json.dumps(p, ensure_ascii=False, indent=1))
    return str(folder)


def test_both_footprints_and_an_unknown_field_in_one_page(spark, tmp_path):
    path = put(tmp_path, {"value": ITEMS[:3]}, {"value": []}, {"other": 1})
    flat = flatten_open(read_open_items(spark, path))
    assert flat.columns == [
        "Attributes", "GeoFootprint.coordinates", "GeoFootprint.type", "ID", "Id.2", "New.x.y", "a b.c.d", "a b.it's", "gone", "n",
    ] or flat.columns[3:5] == ["ID", "Id.2"]
    rows = {r["Id.2"]: r for r in flat.collect()}
    assert rows["a"]["a b.c.d"] == 1 and rows["a"]["a b.it's"] is True and rows["a"]["gone"] is None and rows["a"]["New.x.y"] is None
    assert rows["b"]["New.x.y"] == "ñ" and rows["b"]["GeoFootprint.type"] == "MultiPolygon" and rows["c"]["ID"] == 7
    assert [rows[i]["n"] for i in "abc"] == [1.0, 2.5, 3.0]
    assert rows["c"]["Attributes"].toPython()[1] == {"Name": "q", "value": "1"} and rows["c"]["GeoFootprint.coordinates"] is None
    # and with the schema, as products
    found = read_paged_json(spark, path, CATALOGUE_ITEM)
    rings = {r.Id: r.rings for r in found.select("Id", geojson_rings("GeoFootprint").alias("rings")).collect()}
    assert len(rings["a"]) == 1 and len(rings["b"]) == 2 and rings["c"] is None and rings["b"][1][2].y == 7.5
    texts = {r.Id: r.footprint for r in product_columns(found, "sentinel2").select("Id", "footprint").collect()}
    assert json.loads(texts["b"])["coordinates"][1][0][2] == [6, 7.5] and texts["c"] is None


def test_a_field_of_several_kinds_stays_open(spark, tmp_path):
    items = read_open_items(spark, put(tmp_path, {"value": ITEMS}))
    flat = flatten_open(items.select(F.lit(1).alias("page"), "item"), sep="_")
    assert dict(flat.dtypes)["New"] == "variant" and dict(flat.dtypes)["n"] == "double" and flat.columns[0] == "page"
    assert sorted(r.t for r in flat.select(F.to_json("New").alias("t")).where("t IS NOT NULL").collect()) == ['"now a text"', '{"x":{"y":"ñ"}}', '{"x":{"y":null}}']


def test_fields_given_beforehand_and_too_many(spark, tmp_path):
    first, second = (read_open_items(spark, put(tmp_path / str(i), {"value": [ITEMS[i]]})) for i in (0, 1))
    fields = item_fields(first)
    assert flatten_open(second, fields=fields).columns == flatten_open(first).columns
    with pytest.raises(ValueError, match="more than 3"):
        flatten_open(first, max_fields=3)
    with pytest.raises(ValueError, match="not objects"):
        item_fields(read_open_items(spark, put(tmp_path / "numbers", {"value": [1, 2]})))
    none = read_open_items(spark, put(tmp_path / "none", {"value": []}))
    assert none.count() == 0 and flatten_open(none).columns == []


@pytest.mark.parametrize("one_per_line", [False, True])
def test_a_torn_page_stops_the_job(spark, tmp_path, one_per_line):
    path = put(tmp_path, json.dumps({"value": ITEMS[:1]}), '{"value": [{"Id": "x"}, {"Id"')
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ_FILE"):
        read_open_items(spark, path, one_page_per_line=one_per_line).collect()
    assert read_open_items(spark, path, one_page_per_line=one_per_line, mode="PERMISSIVE").count() == 1


def test_open_columns_go_out_as_json(spark, tmp_path):
    flat = flatten_open(read_open_items(spark, put(tmp_path / "in", {"value": ITEMS[:2]})))
    path = save_theme(flat.select(F.col("`GeoFootprint.coordinates`").alias("c")), "satelital", "open", str(tmp_path / "out"))
    assert sorted(len(json.loads(r.c)) for r in spark.read.option("header", True).option("escape", '"').csv(path).collect()) == [1, 2]


def test_one_aggregation_finds_the_fields(spark, tmp_path, plan):
    items = read_open_items(spark, put(tmp_path, {"value": ITEMS}))
    text = plan(items.agg(F.schema_of_variant_agg("item")))
    assert "partial_schema_of_variant_agg" in text and "Python" not in text
